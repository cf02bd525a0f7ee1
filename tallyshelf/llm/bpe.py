"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

A rank file becomes a BPE model over characters: each of the 256 bytes has one visible character,
and every split of a token into two known tokens is a merge, ordered by the token's rank. A text is
split by the pattern, its pieces are mapped byte by byte to characters, and each piece is encoded on
its own; offsets, counted in mapped characters and so in bytes, say which tokens belong to a piece.
Decoding turns token characters back into bytes; a character split over tokens is whole again once
the bytes are joined.

Defined cases: a null or empty text has no tokens; rows are independent, so repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyshelf.llm import shared

#: Pieces a worker remembers before it starts anew; bounds memory, changes no result.
REMEMBERED_PIECES = 150_000
#: Longest piece that is remembered, in characters.
REMEMBERED_LENGTH = 64


def byte_characters() -> list[str]:
    """A visible character for each byte: itself where printable in Latin-1, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the text of a rank file (base64, space, rank)."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Coder:
    """Encoder and decoder of one rank file and one splitting pattern; the encoder is made at first use."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.ranks = read_ranks(rank_lines)
        self.pattern = pattern
        self.characters = byte_characters()
        # The byte table, and the way back from a token's characters.
        back = {c: b for b, c in enumerate(self.characters)}
        self.token_bytes: list[bytes | None] = [None] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.token_bytes[rank] = bytes(map(back.__getitem__, self._mapped(token)))
        self.known: dict[str, bytes] = {}

    def _mapped(self, token: bytes) -> str:
        return "".join(map(self.characters.__getitem__, token))

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, mapped = self.ranks, {t: self._mapped(t) for t in self.ranks}
        merges = []
        for token in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__):
            halves = ((token[:i], token[i:]) for i in range(1, len(token)))
            known = [(ranks[a], ranks[b], mapped[a], mapped[b]) for a, b in halves if a in ranks and b in ranks]
            merges += [(a, b) for _, _, a, b in sorted(known)]
        vocabulary = {mapped[t]: r for t, r in ranks.items()}
        found = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True, cache_capacity=0))
        found.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return found

    @cached_property
    def split(self):
        import regex

        # White space by its Unicode property, as the rank file's own library takes it.
        return regex.compile(self.pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    @cached_property
    def to_characters(self) -> dict[int, str]:
        # 0xFF never occurs in UTF-8, so it can part pieces; white space has no mapped character.
        return {b: c for b, c in enumerate(self.characters)} | {0xFF: " "}

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raw = "\udcff".join(pieces).encode("utf-8", "surrogateescape")
        encoded = self.tokenizer.encode(raw.decode("latin-1").translate(self.to_characters), add_special_tokens=False)
        starts = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded.offsets))
        ends = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in pieces), np.int64, len(pieces)))
        ids = np.array(encoded.ids, dtype="<u4").tobytes()
        cuts = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED_PIECES:
            self.known = {}
        pieces = [self.split(t) for t in texts]
        new = list(set().union(*pieces).difference(self.known))
        found = dict(zip(new, self._encode_pieces(new))) if new else {}
        out = [b"".join([self.known.get(p) or found[p] for p in ps]) for ps in pieces]
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= REMEMBERED_LENGTH)
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def starts(self, ids: bytes) -> list[int]:
        """Code point in which each token begins; tokens that share a split character share it."""
        raw = self.decode(ids)
        lengths = [len(self.token_bytes[i]) for i in np.frombuffer(ids, "<u4").tolist()]
        begins = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        at = np.cumsum([0, *lengths[:-1]]) if lengths else []
        return [int(x) - 1 for x in np.cumsum(begins)[at]] if lengths else []

    def text(self, tokens: Iterator[int]) -> Iterator[str]:
        """Text token by token; bytes of a split character wait for the token that completes it."""
        held = codecs.getincrementaldecoder("utf-8")("replace")
        for token in tokens:
            yield held.decode(self.token_bytes[token])
        yield held.decode(b"", True)


@lru_cache(maxsize=4)
def coder(rank_lines: bytes, pattern: str) -> Coder:
    return Coder(rank_lines, pattern)


def _some(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_tokens (long), ids (little-endian unsigned 32-bit integers).

    The rank file is read once by the driver and sent out; its size is that of a vocabulary.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        lines = spark.sparkContext.broadcast(file.read())
    picked = docs.select(F.col(key).alias(key), shared.whole(F.col(text)).alias("body"))
    schema = T.StructType(
        [picked.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def run(batches):
        own = coder(lines.value, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [x for part in _some(texts) for x in own.encode(part)]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(ids, pa.binary())], [key, "n_tokens", "ids"])
        # Workers outlive their tasks; what they remember must not.
        del own
        coder.cache_clear()

    return picked.mapInArrow(shared.released(run), schema)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with a column ``decoded`` (binary) that holds the bytes of ``ids``; null ids are empty."""
    spark = tokens.sparkSession
    with open(ranks_path, "rb") as file:
        lines = spark.sparkContext.broadcast(file.read())
    schema = T.StructType([*(f for f in tokens.schema if f.name != "decoded"), T.StructField("decoded", T.BinaryType())])
    rest = [f.name for f in tokens.schema if f.name != "decoded"]

    def run(batches):
        own = coder(lines.value, pattern)
        for batch in batches:
            raw = [own.decode(x or b"") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*rest, "decoded"])
        del own
        coder.cache_clear()

    return tokens.select(*rest).mapInArrow(shared.released(run), schema)


def sha256_of(column: str):
    return F.sha2(F.coalesce(F.col(column), F.lit(b"")), 256)


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
