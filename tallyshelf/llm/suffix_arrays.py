"""Exact removal of repeated passages with suffix arrays by induced sorting.

A byte is removed if it lies in a string of ``length`` bytes that also starts earlier: in a document
with a smaller id, or earlier in the same document. Strings are judged on the input.

1. Anchors. Every window of ``length`` bytes chooses its smallest 32-byte gram by hash; equal windows
   choose the same gram at the same place, so all copies of a window meet under one gram. An anchor's
   context is what its windows can cover. Where a gram has the same context again, everything in the
   later one is repeated, and no bytes need to move. Each Arrow batch settles its own copies first.
2. Shards. Only grams with different contexts need their bytes. Contexts are dealt by gram and laid
   into shard texts of bounded size, parted by a byte that no text holds.
3. Suffix array of a shard: suffixes are classified, the substrings between leftmost-smaller (LMS)
   positions are sorted by induction and named, the string of names is sorted by naming pairs, pairs
   of pairs and so on until all names differ, and the full array is induced from it, bucket by
   bucket, each a step over whole arrays. Permuted common prefixes are compared only where the
   preceding bytes differ; everywhere else they are one less than their left neighbour's.
4. Neighbours with ``length`` common bytes are copies of one window; all but the earliest are marked.

A gram with more than ``most_contexts`` contexts is not put into one shard: each of its windows is
named by 128 bits of its content and the earliest of each is found by a partially aggregated minimum.

Defined cases: a null text is empty; a text shorter than ``length`` loses nothing; a null id comes
before all others; rows with the same id are ordered by a checksum of their text, and rows that are
equal in both are one document and get the same result each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tallyshelf.llm import shared


@dataclass(frozen=True)
class Settings:
    length: int = 100
    #: Bytes of a shard's text, about.
    shard_bytes: int = 4 << 20
    most_contexts: int = 20_000

    @property
    def gram(self) -> int:
        """Bytes of an anchor: a power of 2, about a third of the length."""
        return 1 << max(0, (self.length // 3).bit_length() - 1)

    @property
    def reach(self) -> int:
        """How far the windows of an anchor go beyond it on either side."""
        return self.length - self.gram


# ---- anchors ---------------------------------------------------------------------------------

#: Windows looked at together.
_STEP = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    span, base = 1, 0xD6E8FEB86659FD93
    while span < size:
        h = h[:-span] * np.uint64(base) + h[span:]
        base = base * base % (1 << 64)
        span *= 2
    return (h ^ (h >> np.uint64(32))) * _MIX | np.uint64(1)


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that windows choose; texts lie end to end, ``ends`` says where each ends."""
    length, gram, width = settings.length, settings.gram, settings.reach + 1
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for a in range(0, data.size - length + 1, _STEP):
        b = min(a + _STEP, data.size - length + 1)
        h = _grams(data[a : b + length - 1], gram)
        least = _slide(h, width, np.minimum)
        # No window reaches over the end of a text.
        lo, hi = np.searchsorted(ends, [a, b + length], side="right")
        for end in ends[lo:hi].tolist():
            least[max(0, end - length + 1 - a) : max(0, end - a)] = 0
        pad = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(_slide(np.concatenate((pad, least, pad)), width, np.maximum) == h)
        places.append(chosen + a)
        hashes.append(h[chosen])
    at, h = np.concatenate(places), np.concatenate(hashes)
    at, first = np.unique(at, return_index=True)
    return at, h[first]


def _merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the intervals of each document."""
    if not doc.size:
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    # Documents are set apart so that one running maximum serves all.
    apart = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1]))) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + apart)
    new = np.concatenate(([True], (lo + apart)[1:] > reach[:-1]))
    new[1:] |= doc[1:] != doc[:-1]
    starts = np.flatnonzero(new)
    last = np.concatenate((starts[1:], [doc.size])) - 1
    return doc[starts], lo[starts], (reach - apart)[last]


#: kind 0: a context (h, c: gram and context; lo, size: its bytes, left: gram's place in it); kind 1: bytes to remove.
_MARKS = pa.schema(
    [("kind", pa.int32()), ("h", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("crc", pa.int64()), ("lo", pa.int64()), ("left", pa.int32()), ("size", pa.int64())]
)
_MARKS_SQL = "kind int, h long, c long, doc long, crc long, lo long, left int, size long"


def _mark_rows(kind, h, c, doc, crc, lo, left, size) -> pa.RecordBatch:
    n = len(doc)
    fill = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), n).astype(t))
    return pa.RecordBatch.from_arrays(
        [fill(kind, np.int32), fill(h, np.int64), fill(c, np.int64), fill(doc, np.int64), fill(crc, np.int64), fill(lo, np.int64), fill(left, np.int32), fill(size, np.int64)],
        schema=_MARKS,
    )


def _anchor_rows(settings: Settings):
    reach, gram = settings.reach, settings.gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, crcs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw = [x.as_buffer().to_pybytes() for x in batch.column(2)]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            joined = b"".join(raw)
            del raw
            ends = np.cumsum(sizes)
            begins = ends - sizes
            at, h = anchors(np.frombuffer(joined, np.uint8), ends, settings)
            if not at.size:
                continue
            row = np.searchsorted(ends, at, side="right")
            lo = np.maximum(at - reach, begins[row])
            hi = np.minimum(at + gram + reach, ends[row])
            left = at - lo
            view = memoryview(joined)
            c = np.fromiter(
                (xxh3_64_intdigest(view[a:b], s) for a, b, s in zip(lo.tolist(), hi.tolist(), left.tolist())), np.uint64, at.size
            )
            lo, hi = lo - begins[row], hi - begins[row]
            place = np.empty(len(docs), np.int64)
            place[np.lexsort((crcs, docs))] = np.arange(len(docs))
            order = np.lexsort((lo, place[row], c, h))
            h, c, row, lo, hi, left = h[order], c[order], row[order], lo[order], hi[order], left[order]
            again = np.concatenate(([False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])))
            first = ~again
            yield _mark_rows(0, h[first].view(np.int64), c[first].view(np.int64), docs[row[first]], crcs[row[first]], lo[first], left[first], (hi - lo)[first])
            # Copies of one row are one document: the same place again is no repeat.
            begin = np.maximum.accumulate(np.where(first, np.arange(first.size), 0))
            at_begin = row[begin]
            again &= ~((docs[row] == docs[at_begin]) & (crcs[row] == crcs[at_begin]) & (lo == lo[begin]))
            r, a, b = _merged(row[again], lo[again], hi[again])
            yield _mark_rows(1, docs[r], 0, docs[r], crcs[r], a, 0, b - a)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by kind, gram, context and place: later copies of a context become removals; contexts
    of grams with different contexts go on; a gram's only context is dropped. One row is held over."""
    names = _MARKS.names
    held: list[np.ndarray] | None = None
    held_several = False
    seen: tuple | None = None
    for batch in batches:
        cols = [batch.column(n).to_numpy() for n in names]
        removal = cols[0] == 1
        if removal.any():
            yield _mark_rows(*(x[removal] for x in cols))
        cols = [x[~removal] for x in cols]
        if not cols[0].size:
            continue
        h, c = cols[1], cols[2]
        again = np.concatenate(([seen is not None and seen[:2] == (h[0], c[0])], (h[1:] == h[:-1]) & (c[1:] == c[:-1])))
        # Where the run of each row began; -1: in an earlier batch.
        begin = np.maximum.accumulate(np.where(again, -1, np.arange(again.size)))
        places = cols[3:6]
        before = seen[2:] if seen is not None else (0, 0, 0)
        origin = [np.where(begin < 0, old, x[begin]) for old, x in zip(before, places)]
        later = again & ~np.logical_and.reduce([x == o for x, o in zip(places, origin)])
        seen = (h[-1], c[-1], *(o[-1] for o in origin))
        _, _, _, doc, crc, lo, _, size = (x[later] for x in cols)
        if doc.size:
            yield _mark_rows(1, doc, 0, doc, crc, lo, 0, size)
        cols = [x[~again] for x in cols]
        if not cols[0].size:
            continue
        if held is not None:
            cols = [np.concatenate((a, b)) for a, b in zip(held, cols)]
        same = cols[1][1:] == cols[1][:-1]
        several = np.concatenate(([held_several if held is not None else False], same))
        several[:-1] |= same
        go = several.copy()
        go[-1] = False
        yield _mark_rows(*(x[go] for x in cols))
        held, held_several = [x[-1:] for x in cols], bool(several[-1])
    if held is not None and held_several:
        yield _mark_rows(*held)


# ---- suffix arrays ---------------------------------------------------------------------------


def _suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; equal bytes take the type of what follows them."""
    step = np.sign(np.diff(text.astype(np.int16)))
    step = np.append(step, 1)
    at = np.where(step != 0, np.arange(text.size), text.size)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


class _Buckets:
    """Lists of suffixes by first byte, filled in order."""

    def __init__(self):
        self.lists: list[list[np.ndarray]] = [[] for _ in range(256)]

    def put(self, suffixes: np.ndarray, first: np.ndarray) -> None:
        if not suffixes.size:
            return
        order = np.argsort(first, kind="stable")
        first, suffixes = first[order], suffixes[order]
        cuts = [0, *(np.flatnonzero(first[1:] != first[:-1]) + 1).tolist(), first.size]
        for a, b in zip(cuts, cuts[1:]):
            self.lists[first[a]].append(suffixes[a:b])

    def take(self, byte: int) -> np.ndarray:
        found = self.lists[byte]
        self.lists[byte] = []
        return np.concatenate(found) if found else np.empty(0, np.int32)


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from LMS suffixes in order: larger ones upwards, then smaller ones downwards."""
    seeds = _Buckets()
    seeds.put(lms, text[lms])
    larger = _Buckets()
    sorted_larger: list[np.ndarray] = []

    def pass_on(suffixes: np.ndarray, want_small: bool, byte: int, to: _Buckets) -> np.ndarray:
        """Left neighbours of the wanted type go to their buckets; those of the same byte come back."""
        before = suffixes[suffixes > 0] - 1
        before = before[small[before] == want_small]
        first = text[before]
        same = first == byte
        if same.any():
            to.put(before[~same], first[~same])
            return before[same]
        to.put(before, first)
        return before[:0]

    for byte in range(256):
        parts = [larger.take(byte)]
        while parts[-1].size:
            parts.append(pass_on(parts[-1], False, byte, larger))
        sorted_larger.append(np.concatenate(parts))
        pass_on(seeds.take(byte), False, byte, larger)
    smaller = _Buckets()
    out: list[np.ndarray] = []
    for byte in range(255, -1, -1):
        parts = [smaller.take(byte)]
        while parts[-1].size:
            parts.append(pass_on(parts[-1], True, byte, smaller))
        own = sorted_larger[byte][::-1]
        pass_on(own, True, byte, smaller)
        out += [*parts, own]
    # The end of the text is the smallest suffix and is induced by none.
    out.append(np.array([text.size - 1], np.int32))
    return np.concatenate(out)[::-1]


def _named(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Number of each LMS substring, in text order; equal substrings share a number."""
    size = np.append(np.diff(lms), 0) + 1
    a, b = order[:-1], order[1:]
    differ = size[a] != size[b]
    active = np.flatnonzero(~differ)
    k = 0
    while active.size:
        unequal = text[lms[a[active]] + k] != text[lms[b[active]] + k]
        differ[active[unequal]] = True
        k += 1
        active = active[~unequal]
        active = active[size[a[active]] > k]
    names = np.empty(lms.size, np.int64)
    names[order] = np.concatenate(([0], np.cumsum(differ)))
    return names


def _rank_names(names: np.ndarray) -> np.ndarray:
    """Rank of every suffix of the string of names: names of pairs, of pairs of pairs, until all differ."""
    n = names.size
    order = np.argsort(names, kind="stable")
    head = np.concatenate(([True], names[order][1:] != names[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    open_ = order[~(head & np.append(head[1:], True))]
    while open_.size:
        after = open_ + step
        key = (rank[open_] << 32) | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        group = key >> 32
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        index = np.arange(open_.size)
        offset = index - np.maximum.accumulate(np.where(new_group, index, 0))
        rank[open_] = group + np.maximum.accumulate(np.where(new_key, index, 0)) - index + offset
        open_ = open_[~(new_key & np.append(new_key[1:], True))]
        step *= 2
    return rank


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``text`` (bytes; the last is 0 and stands nowhere else)."""
    if text.size == 1:
        return np.zeros(1, np.int32)
    small = _suffix_types(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    first = _induce(text, small, lms)
    index = np.full(text.size, -1, np.int32)
    index[lms] = np.arange(lms.size, dtype=np.int32)
    order = index[first]
    order = order[order >= 0]
    names = _named(text, lms, order)
    if names[order[-1]] + 1 < lms.size:
        order = np.argsort(_rank_names(names))
    return _induce(text, small, lms[order])


def permuted_common_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix, in text order, with its predecessor in the array."""
    n = text.size
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    place = np.arange(n)
    # A suffix and its predecessor that follow equal bytes: one less than their left neighbours share.
    reducible = (before > 0) & (place > 0)
    reducible[reducible] = text[place[reducible] - 1] == text[before[reducible] - 1]
    at = np.flatnonzero(~reducible & (before >= 0))
    words = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(8, np.uint8)), 8)[:n]
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    other = before[at]
    common = np.zeros(at.size, np.int64)
    active = np.arange(at.size)
    while active.size:
        i, j = at[active] + common[active], other[active] + common[active]
        inside = (i < n) & (j < n)
        differ = np.full(active.size, np.uint64(1))
        differ[inside] = words[i[inside]] ^ words[j[inside]]
        # The lowest set byte is the first that differs.
        equal = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3
        common[active] += equal
        active = active[differ == 0]
    start = np.zeros(n, np.int64)
    start[at] = common + at
    known = np.zeros(n, bool)
    known[at] = True
    known[before < 0] = True
    last = np.maximum.accumulate(np.where(known, place, 0))
    return np.maximum(0, start[last] - place)


def repeated_windows(contexts: list[bytes], doc: np.ndarray, lo: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows (context number, place in it) that also start earlier; contexts lie in documents of rank ``doc`` at ``lo``."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    text = np.frombuffer(b"\xfe".join(contexts) + b"\xfe\xff", np.uint8) + np.uint8(1)
    array = suffix_array(text)
    same = permuted_common_prefixes(text, array)[array] >= length
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    members = same | np.append(same[1:], False)
    suffix, joins = array[members], same[members]
    context = np.searchsorted(begins, suffix, side="right") - 1
    offset = suffix - begins[context]
    inside = offset + length <= sizes[context]
    # Runs hold windows only or none, as only the others reach over a separator.
    suffix, joins, context, offset = suffix[inside], joins[inside], context[inside], offset[inside]
    if not suffix.size:
        return context, offset
    when = (doc[context] << 40) | (lo[context] + offset)
    starts = np.flatnonzero(~joins)
    earliest = np.repeat(np.minimum.reduceat(when, starts), np.diff(np.append(starts, suffix.size)))
    later = when > earliest
    return context[later], offset[later]


# ---- jobs ------------------------------------------------------------------------------------


def _contexts(settings: Settings):
    """Bytes of the contexts that a document needs; those of crowded grams window by window, named by content."""
    schema = pa.schema([("h", pa.int64()), ("w", pa.binary()), ("doc", pa.int64()), ("crc", pa.int64()), ("lo", pa.int64()), ("bytes", pa.binary())])

    def run(batches):
        for batch in batches:
            rows = [[] for _ in schema]
            for doc, crc, body, wanted in zip(*(batch.column(i) for i in range(4))):
                raw = body.as_buffer().to_pybytes()
                for need in wanted.as_py():
                    lo, size = need["lo"], need["size"]
                    if need["crowded"]:
                        for at in range(lo, lo + size - settings.length + 1):
                            values = (0, xxh3_128_digest(raw[at : at + settings.length]), doc, crc, at, None)
                            for column, value in zip(rows, values):
                                column.append(value)
                    else:
                        for column, value in zip(rows, (need["h"], None, doc, crc, lo, raw[lo : lo + size])):
                            column.append(value)
                if len(rows[0]) > 20_000:
                    yield _context_rows(rows, schema)
                    rows = [[] for _ in schema]
            if rows[0]:
                yield _context_rows(rows, schema)

    return run


def _context_rows(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    plain = lambda values: [x.as_py() if isinstance(x, pa.Scalar) else x for x in values]
    return pa.RecordBatch.from_arrays([pa.array(plain(c), f.type) for c, f in zip(rows, schema)], schema=schema)


def _shards(settings: Settings):
    """Removals (doc, crc, lo, size) from rows sorted by gram; a gram never goes into two shards."""
    schema = pa.schema([("doc", pa.int64()), ("crc", pa.int64()), ("lo", pa.int64()), ("size", pa.int64())])

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        doc, crc, lo = (table.column(n).to_numpy() for n in ("doc", "crc", "lo"))
        order = np.lexsort((crc, doc))
        new = np.concatenate(([False], (doc[order][1:] != doc[order][:-1]) | (crc[order][1:] != crc[order][:-1])))
        rank = np.empty(doc.size, np.int64)
        rank[order] = np.cumsum(new)
        context, offset = repeated_windows(table.column("bytes").to_pylist(), rank, lo, settings.length)
        first = np.full(int(rank.max()) + 1, -1, np.int64)
        first[rank] = np.arange(doc.size)
        at = lo[context] + offset
        r, a, b = _merged(rank[context], at, at + settings.length)
        at_row = first[r]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[at_row]), pa.array(crc[at_row]), pa.array(a, pa.int64()), pa.array(b - a, pa.int64())], schema=schema
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy()
            edges = [0, *(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), batch.num_rows]
            upto = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy())))
            begin = 0
            for a, b in zip(edges, edges[1:]):
                if size + upto[a] - upto[begin] >= settings.shard_bytes and h[a] != last:
                    if a > begin:
                        held.append(batch.slice(begin, a - begin))
                    yield solve(held)
                    held, size, begin = [], 0, a
                last = h[a]
            held.append(batch.slice(begin))
            size += int(upto[-1] - upto[begin])
        if held:
            yield solve(held)

    return run


def removals(docs: DataFrame, scratch: shared.Scratch, settings: Settings) -> DataFrame:
    """(doc, crc, lo, size) of bytes to remove, overlaps included; ``docs`` has doc, crc, body."""
    marks = docs.where(F.octet_length("body") >= settings.length).mapInArrow(_anchor_rows(settings), _MARKS_SQL)
    order = ["kind", "h", "c", "doc", "crc", "lo"]
    marks = scratch.write(marks.repartition("h").sortWithinPartitions(*order).mapInArrow(_settle, _MARKS_SQL))
    needed = marks.where("kind = 0")
    crowded = needed.groupBy("h").count().where(F.col("count") > settings.most_contexts).select("h", F.lit(True).alias("crowded"))
    needed = needed.join(crowded, "h", "left").select(
        "doc", "crc", F.struct("h", "lo", "size", F.coalesce("crowded", F.lit(False)).alias("crowded")).alias("need")
    )
    per_doc = needed.groupBy("doc", "crc").agg(F.collect_list("need").alias("needs"))
    texts = docs.join(per_doc, ["doc", "crc"]).select("doc", "crc", "body", "needs")
    contexts = texts.mapInArrow(_contexts(settings), "h long, w binary, doc long, crc long, lo long, bytes binary")
    if not crowded.isEmpty():
        contexts = scratch.write(contexts)
        windows = contexts.where("w is not null").select("w", "doc", "crc", "lo")
        earliest = windows.groupBy("w").agg(F.min(F.struct("doc", "crc", "lo")).alias("first"), F.count("*").alias("n"))
        again = windows.join(earliest.where("n > 1"), "w").where(F.struct("doc", "crc", "lo") != F.col("first"))
        again = again.select("doc", "crc", "lo", F.lit(settings.length).cast("long").alias("size"))
        contexts = contexts.where("w is null")
    else:
        again = None
    dealt = contexts.select("h", "doc", "crc", "lo", "bytes").repartition("h").sortWithinPartitions("h")
    found = scratch.write(dealt.mapInArrow(_shards(settings), "doc long, crc long, lo long, size long"))
    found = found.union(marks.where("kind = 1").select("doc", "crc", "lo", "size"))
    return found.union(again) if again is not None else found


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, kept (binary).

    Intermediate tables are written when this is called.
    """
    scratch = shared.Scratch(docs.sparkSession, "suffix-arrays")
    body = F.encode(shared.whole(F.col(text)), "UTF-8")
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("doc"), F.crc32(body).alias("crc"), body.alias("body")
    )
    found = removals(rows.select("doc", "crc", "body"), scratch, settings)
    per_doc = found.groupBy("doc", "crc").agg(F.collect_list(F.struct("lo", "size")).alias("cuts"))
    joined = rows.join(per_doc, ["doc", "crc"], "left").select("id", "body", "cuts")
    schema = T.StructType(
        [
            joined.schema["id"],
            *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def run(batches):
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for item, cuts in zip(batch.column(1), batch.column(2)):
                raw = item.as_buffer().to_pybytes()
                if cuts.is_valid and len(cuts):
                    lo, size = cuts.values.field(0).to_numpy(), cuts.values.field(1).to_numpy()
                    _, a, b = _merged(np.zeros(lo.size, np.int64), lo, lo + size)
                else:
                    a = b = np.empty(0, np.int64)
                parts = zip([0, *b.tolist()], [*a.tolist(), len(raw)])
                sizes.append(len(raw))
                removed.append(int((b - a).sum()))
                spans.append(a.size)
                kept.append(b"".join(raw[x:y] for x, y in parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                [f.name for f in schema],
            )

    return joined.mapInArrow(run, schema).withColumnRenamed("id", key)
