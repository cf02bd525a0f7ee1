"""Collocations from a prefix-free parsing.

A text is a sequence of words and breaks: A-Z lower-cased, cut at break characters into pieces and those
at blanks into words. It is parsed into chunks by its own content: a word whose hash is divisible by
``every`` begins a chunk, and a chunk reaches ``most_words`` - 1 tokens into the next one. The distinct
chunks of a language are the dictionary, with the number of times they occur in the parse. Equal
passages are parsed alike wherever they stand, so copies only raise a frequency. An n-gram of up to
``most_words`` words is counted in the one chunk in which it begins before the chunk's end word, so
overlaps are counted once; counts inside a distinct chunk are weighted by its frequency.

Counting takes three passes over the dictionary. The first adds up words and pairs of words in bins by
their hash, one byte per bin and task, saturating at ``least``: a bin that stays below ``least`` holds
nothing frequent. The second does so with the triples whose pairs pass. The third counts words, pairs
that pass, and n-grams all of whose triples pass, by their text. Each pass reads the dictionary in two parts a core at most, so what the parts
send grows with the phrases, not with parts times phrases. Bins never lose a frequent phrase, they only keep rare ones from being moved; their number
follows the size of the dictionary and ends at ``most_bins``, beyond which more rare phrases are moved
and counted, with the same result. The driver and each task hold one bit per bin.

A candidate of ``least`` or more occurrences is cut after each of its words; its score is its count against
what the counts of both sides let expect, at the worst cut. A candidate inside a longer one that occurs
as often is dropped: by comparing with phrases one word longer, because counts only fall with length.

Defined cases: a null or empty text has no words; a null language is ``und``; rows with the same id are
texts of their own, repeated rows count each; ties at the cut in the list are by count, then by phrase;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyshelf.llm import shared

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A byte that no UTF-8 text holds stands for a break.
_BREAK = b"\xff"
_TO_BREAK = bytes.maketrans(_BREAKS, _BREAK * len(_BREAKS))
#: Bins that are added up together; places within a block fit 16 bits.
_BLOCK = 1 << 16
#: Phrases whose counts a task adds up before it sends them on.
_HELD = 400_000


def tokens(text: bytes) -> list[bytes]:
    """Words of ``text``, and a break between pieces."""
    marked = text.lower().translate(_TO_BREAK).replace(_BREAK, b" \xff ")
    return marked.replace(b"\t", b" ").split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=False) if words else np.zeros(0, np.uint64)


def _encoded(lists: list[list[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Numbers of all tokens, end to end; the distinct tokens by number; where each list ends."""
    flat = pa.array([t for part in lists for t in part], pa.binary()).dictionary_encode()
    return flat.indices.to_numpy(), flat.dictionary.to_pylist(), np.cumsum([len(x) for x in lists])


def _starts(token_hash: np.ndarray, is_break: np.ndarray, every: int) -> np.ndarray:
    """Tokens that begin a chunk by their content."""
    return (token_hash % np.uint64(every) == 0) & ~is_break


def parse(docs: DataFrame, text: str, lang: str, every: int, most_words: int) -> DataFrame:
    """(lang, chunk, n): the distinct chunks of each language and how often the parse holds them.

    Tokens of a chunk are separated by blanks, a break is a line feed.
    """
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    bodies = docs.select(language, shared.whole(F.col(text)).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [tokens(body.as_buffer().to_pybytes()) for body in batch.column("body")]
            codes, words, ends = _encoded(lists)
            begins = _starts(_hashes(words), np.array([w == _BREAK for w in words], bool), every)[codes]
            langs, found, last = batch.column("lang").to_pylist(), {}, 0
            for language, parts, end in zip(langs, lists, ends.tolist()):
                at = np.flatnonzero(begins[last:end]).tolist()
                last = end
                bounds = [0, *(i for i in at if i), len(parts)]
                for start, stop in zip(bounds, bounds[1:]):
                    if start < stop:
                        chunk = language, b" ".join(parts[start : stop + most_words - 1]).replace(_BREAK, b"\n")
                        found[chunk] = found.get(chunk, 0) + 1
            chunks = pa.array([c for _, c in found], pa.binary()).cast(pa.string())
            columns = [pa.array([x for x, _ in found], pa.string()), chunks, pa.array(list(found.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "n"])

    chunks = bodies.mapInArrow(run, "lang string, chunk string, n long")
    return chunks.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


class Grams:
    """Words and n-grams of a batch of chunks, each counted where it begins before its chunk's end word.

    ``codes``, ``weight``, ``lang`` and ``room`` stand side by side for all tokens: the number of the token, the
    frequency of its chunk, the number of its language, and how many words may follow in its piece
    and chunk, itself included, 0 for tokens that are not counted from.
    """

    def __init__(self, batch: pa.RecordBatch, every: int, most_words: int):
        lists = [chunk.as_buffer().to_pybytes().replace(b"\n", _BREAK).split() for chunk in batch.column("chunk")]
        self.codes, self.words, ends = _encoded(lists)
        self.hash = _hashes(self.words)
        breaks = np.array([w == _BREAK for w in self.words], bool)
        sizes = np.diff(ends, prepend=0)
        weight, langs = batch.column("n").to_numpy(), batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.weight, self.lang = np.repeat(weight, sizes), np.repeat(langs.indices.to_numpy(), sizes)
        at = np.arange(self.codes.size)
        stop = np.repeat(ends, sizes)
        is_break = breaks[self.codes]
        # The nearest break at or after each token, or the end of its chunk.
        next_break = np.minimum.accumulate(np.where(is_break, at, at.size)[::-1])[::-1] if at.size else at
        self.room = np.minimum(np.minimum(next_break, stop) - at, most_words)
        # The chunk's own tokens end where the next chunk begins: at its first beginning after its first token.
        begins = _starts(self.hash, breaks, every)[self.codes]
        first = np.repeat(ends - sizes, sizes)
        ended = np.cumsum(begins & (at > first))
        before = ended[first] if at.size else ended
        self.room[ended > before] = 0

    def bins_of(self, words: int, bins: int) -> np.ndarray:
        """The bin of the n-gram of ``words`` words at each token; of no use where it has not as much room."""
        mixed = self.hash[self.codes]
        for i in range(1, words):
            mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ (self.hash[np.roll(self.codes, -i)] + (mixed >> np.uint64(29)))
        return _bin(mixed, bins)


class Dense:
    """One bit per bin."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.bins = bits.tobytes(), bits.size * 8

    def passes(self, at: np.ndarray) -> np.ndarray:
        packed = np.frombuffer(self.bits, np.uint8)
        return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _bin(hashes: np.ndarray, bins: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - (bins.bit_length() - 1))).astype(np.int64)


def _dealt(chunks: DataFrame) -> DataFrame:
    """The same rows in two parts a core at most, read as they lie.

    Every part sends what it found of each frequent phrase, so its rows are added up over as many chunks as
    the cores allow, and a larger dictionary does not bring more parts.
    """
    return chunks.coalesce(2 * chunks.sparkSession.sparkContext.defaultParallelism)


def _dense_bins(
    chunks: DataFrame, bins: int, least: int, every: int, most_words: int, pairs: Dense | None = None
) -> Dense:
    """Bins in which words and pairs - or, given dense ``pairs``, triples of such - occur ``least`` times or more in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bins, np.uint8)
        top = min(least, 255)
        for batch in batches:
            grams = Grams(batch, every, most_words)
            if pairs is None:
                counted = {1: grams.room > 0, 2: grams.room > 1}
            else:
                dense = pairs.passes(grams.bins_of(2, pairs.bins))
                counted = {3: (grams.room > 2) & dense & np.roll(dense, -1)}
            at = np.concatenate([grams.bins_of(k, bins)[on] for k, on in counted.items()])
            used, where = np.unique(at, return_inverse=True)
            sums = np.bincount(where, np.concatenate([grams.weight[on] for on in counted.values()]), used.size)
            held[used] = np.minimum(held[used] + sums, top).astype(np.uint8)
        used = np.flatnonzero(held)
        blocks, begins = np.unique(used // _BLOCK, return_index=True)
        parts = np.split(used, begins[1:]) if used.size else []
        columns = [
            pa.array(blocks, pa.int64()),
            pa.array([(part % _BLOCK).astype("<u2").tobytes() for part in parts], pa.binary()),
            pa.array([held[part].tobytes() for part in parts], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["block", "places", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, places, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                held = sums.setdefault(block, np.zeros(_BLOCK, np.int64))
                held[np.frombuffer(places.as_buffer(), "<u2")] += np.frombuffer(counts.as_buffer(), np.uint8)
        dense = {block: np.packbits(held >= min(least, 255)).tobytes() for block, held in sums.items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(dense), pa.int64()), pa.array(list(dense.values()), pa.binary())], ["block", "bits"]
        )

    counted = _dealt(chunks).mapInArrow(count, "block long, places binary, counts binary").repartition("block")
    bits = np.zeros((bins // _BLOCK, _BLOCK // 8), np.uint8)
    for block, part in counted.mapInArrow(add, "block long, bits binary").collect():
        bits[block] = np.frombuffer(part, np.uint8)
    return Dense(bits.reshape(-1))


def partial_counts(chunks: DataFrame, pairs: Dense, triples: Dense, every: int, most_words: int) -> DataFrame:
    """(lang, phrase, words, n): phrases that pass, counted within each part; words is 0 for all words of a language."""

    def put(held: dict[tuple[str, int, bytes], int]) -> pa.RecordBatch:
        columns = [
            pa.array([lang for lang, _, _ in held], pa.string()),
            pa.array([phrase for _, _, phrase in held], pa.binary()).cast(pa.string()),
            pa.array([k for _, k, _ in held], pa.int32()),
            pa.array(list(held.values()), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, bytes], int] = {}
        for batch in batches:
            grams = Grams(batch, every, most_words)
            words = np.array(grams.words, object)
            out: list[tuple[list, list, int, np.ndarray]] = []
            start = np.flatnonzero(grams.room > 0)
            totals = np.bincount(grams.lang[start], grams.weight[start], len(grams.langs))
            out.append((list(range(len(grams.langs))), [b""] * len(grams.langs), 0, totals))
            dense = {2: pairs.passes(grams.bins_of(2, pairs.bins)), 3: triples.passes(grams.bins_of(3, triples.bins))}
            start = start[pairs.passes(grams.bins_of(1, pairs.bins))[start]]
            # Phrases of k words as numbers; k + 1 words are a phrase and one more word.
            number = grams.lang[start] * np.int64(len(words)) + grams.codes[start]
            for k in range(1, most_words + 1):
                used, firsts, where = np.unique(number, return_index=True, return_inverse=True)
                if not used.size:
                    break
                tokens_of = [words[grams.codes[start[firsts] + i]] for i in range(k)]
                texts = [b" ".join(t) for t in zip(*tokens_of)]
                out.append((grams.lang[start[firsts]].tolist(), texts, k, np.bincount(where, grams.weight[start], used.size)))
                on = grams.room[start] > k
                start, where = start[on], where[on]
                # The last pair of k + 1 words, or their last triple, must pass.
                on = dense[2][start] if k == 1 else dense[3][start + k - 2]
                start, where = start[on], where[on]
                number = where * np.int64(len(words)) + grams.codes[start + k]
            for at, phrases, k, sums in out:
                for i, phrase, n in zip(at, phrases, sums.tolist()):
                    key = grams.langs[i], k, phrase
                    held[key] = held.get(key, 0) + int(n)
            if len(held) > _HELD:
                yield put(held)
                held = {}
        yield put(held)

    return _dealt(chunks).mapInArrow(run, "lang string, phrase string, words int, n long")


def phrase_counts(chunks: DataFrame, pairs: Dense, triples: Dense, least: int, every: int, most_words: int) -> DataFrame:
    """(lang, phrase, words, n): phrases that occur ``least`` times or more; words is 0 for all words of a language."""
    counted = partial_counts(chunks, pairs, triples, every, most_words)
    sums = counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return sums.where((F.col("n") >= least) | (F.col("words") == 0))


def scored(counts: DataFrame, scratch: shared.Scratch) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of every phrase of two words or more, at its worst cut."""
    # Written, so that the planner knows how small it is.
    total = scratch.write(counts.where("words = 0").select("lang", F.col("n").alias("total")))
    phrases = counts.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumn("left", F.array_join(F.slice("w", F.lit(1), F.col("k")), " "))
    cut = cut.withColumn("right", F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " "))
    of = lambda name, count: counts.where("words > 0").select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    sides = cut.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    sides = sides.join(total, "lang")
    # The quotient of whole decimals, exact to 38 digits.
    whole = "CAST({} AS DECIMAL(17,0))".format
    score = F.expr(f"1000BD * ({whole('a')} * {whole('total')}) div ({whole('l')} * {whole('r')})")
    sides = sides.withColumn("score", score)
    worst = sides.groupBy("lang", "phrase", "words", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("at"))
    return worst.select("lang", "phrase", "words", "a", "at.l", "at.r", "n", "at.score")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", *, least: int = 100, most_words: int = 5, first: int = 2000,
    every: int = 32, most_bins: int = 1 << 27,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by score, count and phrase.

    The dictionary and the counts are written when this is called.
    """
    scratch = shared.Scratch(docs.sparkSession, "phrases")
    chunks = scratch.write(parse(docs, text, lang, every, most_words))
    # A bin for every two to four words of the dictionary's chunks.
    bins = min(most_bins, max(_BLOCK, 1 << (chunks.count() * every // 4).bit_length()))
    pairs = _dense_bins(chunks, bins, least, every, most_words)
    triples = _dense_bins(chunks, bins, least, every, most_words, pairs)
    counts = scratch.write(phrase_counts(chunks, pairs, triples, least, every, most_words))
    found = scored(counts, scratch)
    # Counts fall with length, so a longer phrase that occurs as often has one of one word more between.
    w, size = F.split("phrase", " "), F.col("words") - 1
    inner = F.array(F.array_join(F.slice(w, F.lit(1), size), " "), F.array_join(F.slice(w, F.lit(2), size), " "))
    covered = counts.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("longer"))
    covered = covered.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = found.join(covered, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    # Each part of a language sends its first rows only, so no task ranks a whole language.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
