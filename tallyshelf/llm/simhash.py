"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint has one or more words of 64 bits, one for each bit position set in more than half of
the hashes of the text's word shingles (repeats counted; further words hash the hashes). The first
word is cut into segments, and every segment is indexed once for each bit position left out: two
fingerprints that differ by at most one bit in some segment are equal in one of these one-wildcard
variants and meet in a group. Every pair of a group is compared. Only links that tie a group
together are put out, never all pairs, and only distinct fingerprints are indexed, so copies cost
nothing. Two rules are offered:

* ``Bits(4)``: link at up to 4 differing bits of one word. 3 segments hold for 4 bits, so no link is
  lost.
* ``SIMILAR``: link at a Jaccard similarity of the sets of shingles of 0.8 or more. Fingerprints
  (4 words, each different shingle counted once) only propose pairs: up to 56 differing bits of 256,
  found over 5 segments of each of the first two words. A proposed pair links if its sets of 64-bit
  shingle hashes are that similar. Texts with equal sets are one node.

Proposals are checked in two rounds, and no step puts out the pairs of a group. First those that tie the
groups together, each in the first group in which its texts meet. Where a tied group falls apart because checks fail, its texts are cut into blocks and
every two blocks meet in one task: proposed pairs between different parts are checked there, by the
exact counts of common shingles of all texts of the two blocks, and only links that tie parts together
come out. The largest part of a group is known to hold together and is not compared with itself.

Groups above ``group_limit`` of the first rule are not compared as they are: their members, which
agree in the bits of their variant, are regrouped by parts of the other bits, one part more than bits
may differ, so that one part is equal; again and again until every group is small. Of the second rule
they are cut into blocks, and every two blocks are compared by themselves. Neither loses a link.

Defined cases: a null or empty text, or one of white space only, has fingerprint zero and links like
any other; fewer words than a shingle make one shingle of all words; rows are told apart by content,
so repeated rows get the same result; rows with a null id count as members but give no component id;
an empty table gives an empty result; other columns are ignored or carried by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from xxhash import xxh3_128_digest, xxh64_intdigest

from tallyshelf.llm import shared

SEED = 42
#: Hashes whose bits are counted at a time.
_CHUNK = 1 << 16
#: A group up to this size is compared place by place, all groups at once.
SMALL_GROUP = 12
#: Up to this size a group is compared as one matrix.
MATRIX_GROUP = 512


@dataclass(frozen=True)
class Rule:
    """When fingerprints link: up to ``most`` differing bits of ``words`` words, found over ``segments``.

    With a ``similarity`` such fingerprints, found over segments of the first ``searched`` words, only
    propose a pair; it links if its shingle sets are that similar.
    """

    most: int
    segments: int
    words: int = 1
    searched: int = 1
    similarity: float | None = None

    def cuts(self) -> list[tuple[int, int]]:
        ends = [64 * i // self.segments for i in range(self.segments + 1)]
        return list(zip(ends, ends[1:]))


def Bits(most: int) -> Rule:
    """Exact search for up to ``most`` differing bits of one word."""
    return Rule(most, most // 2 + 1)


SIMILAR = Rule(most=56, segments=5, words=4, searched=2, similarity=0.8)
#: Differing bits at which near copies are tied first; nearly all such pairs are similar enough.
CLOSE = 36
#: Up to so many nodes their list is sent to all tasks, and no text is moved to meet it.
SENT_NODES = 500_000


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 values of the text's shingles."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    n = max(1, len(tokens) - width + 1)
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(width)))) if n > 1 else [b" ".join(tokens)]
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)


def fingerprint(text: str | None, width: int, words: int = 1) -> list[int]:
    """Bits set in more than half of the XXH64 values of the text's shingles, and of what they mix to."""
    return majority(shingle_hashes(text, width), words)


def majority(hashes: np.ndarray, words: int) -> list[int]:
    """Bits set in more than half of the values, and of what they mix to."""
    n = len(hashes)
    if not n:
        return [0] * words
    out = []
    for word in range(words):
        counts = np.zeros(64, np.int64)
        for at in range(0, n, _CHUNK):
            bits = np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0]))
        if word + 1 < words:
            hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            hashes ^= hashes >> np.uint64(32)
    return out


def fingerprints(docs: DataFrame, width: int = 5, rule: Rule = SIMILAR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, key of its content, ``fp`` (first word, long, bits as signed).

    With a similarity also ``prints`` (all words), the words searched after the first (``w1`` ...), and
    ``set_a``, ``set_b``, a digest of the set of shingles.
    """
    picked = docs.select(
        F.col(key).alias("id"), *shared.row_key(F.col(key), F.col(text)), shared.whole(F.col(text)).alias("body")
    )
    fields = [*picked.schema.fields[:3], T.StructField("fp", T.LongType(), False)]
    sets = rule.similarity is not None
    if sets:
        longs = [*(f"w{i}" for i in range(1, rule.searched)), "set_a", "set_b"]
        fields += [T.StructField("prints", T.BinaryType(), False), *(T.StructField(n, T.LongType(), False) for n in longs)]

    def run(batches):
        for batch in batches:
            hashes = (shingle_hashes(t.as_py(), width) for t in batch.column(3))
            found, more = [], []
            for h in hashes:
                h = np.unique(h) if sets else h
                found.append(majority(h, rule.words))
                if sets:
                    more.append(np.frombuffer(xxh3_128_digest(h.tobytes()), np.int64))
            columns = [*batch.columns[:3], pa.array([signed(f[0]) for f in found], pa.int64())]
            if sets:
                digests = np.array(more, np.int64).reshape(-1, 2)
                columns.append(pa.array([np.array(f, np.uint64).tobytes() for f in found], pa.binary()))
                columns += [pa.array([signed(f[i]) for f in found], pa.int64()) for i in range(1, rule.searched)]
                columns += [pa.array(digests[:, i].copy()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return picked.mapInArrow(shared.released(run), T.StructType(fields))


def shingle_sets(docs: DataFrame, nodes: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """The different shingle hashes of each of ``nodes`` (node, row_a, row_b): node, shingles."""
    rows = docs.select(*shared.row_key(F.col(key), F.col(text)), shared.whole(F.col(text)).alias("body"))
    if nodes.count() <= SENT_NODES:
        nodes = F.broadcast(nodes)
    picked = rows.join(nodes, ["row_a", "row_b"]).select("node", "body")

    def run(batches):
        for batch in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), width)).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    # Copies of a row are the same node.
    return picked.mapInArrow(shared.released(run), "node long, shingles array<long>").dropDuplicates(["node"])


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Whether fingerprints (rows of words) differ in up to ``most`` bits."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) <= most


def _tie(group: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that hold together what is linked in the group: each member meets all members not yet reached.

    Members are given by their places, as in all functions that find links within a group.
    """
    links, waiting = [], np.arange(len(group))
    while len(waiting):
        frontier, waiting = [waiting[0]], waiting[1:]
        while frontier and len(waiting):
            one = frontier.pop()
            near = _near(group[waiting], group[one], most)
            if near.any():
                reached = waiting[near]
                links.append((np.full(len(reached), one), reached))
                frontier.extend(reached)
                waiting = waiting[~near]
    return links


def _pairs(group: np.ndarray, lo: int, hi: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within ``most`` bits of the members ``lo`` to ``hi`` with later members."""
    # No pair within ``most`` bits differs by more in its first words.
    differing = sum(np.bitwise_count(w[lo:hi, None] ^ w[None, lo:]) for w in group.T[:3])
    a, b = np.nonzero(np.triu(differing <= most, 1))
    near = _near(group[a + lo], group[b + lo], most)
    return a[near] + lo, b[near] + lo


def _matrix_links(group: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """As ``_tie``, from the matrix of all pairs, which is looked through only where it holds many links."""
    a, b = _pairs(group, 0, len(group), most)
    return _tie(group, most) if len(a) > 4 * len(group) else [(a, b)]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the groups of equal keys; rows arrive sorted by them."""
    cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
    starts = np.concatenate(([0], cut))
    return starts, np.diff(np.concatenate((starts, [len(keys[0])])))


def _links(keys: list[np.ndarray], prints: np.ndarray, levels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups of equal keys, as places of rows: ties at each level, at most at the last."""
    most = levels[-1]
    starts, sizes = _groups(*keys)
    left, right = [], []
    small = (sizes > 1) & (sizes <= SMALL_GROUP)
    begin, size = starts[small], sizes[small]
    for j in range(1, int(size.max(initial=0))):
        for i in range(j):
            at = begin[size > j]
            near = _near(prints[at + i], prints[at + j], most)
            left.append(at[near] + i)
            right.append(at[near] + j)
    for at, size in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
        group = prints[at : at + size]
        for level in levels:
            for a, b in (_matrix_links if size <= MATRIX_GROUP else _tie)(group, level):
                left.append(a + at)
                right.append(b + at)
    none = np.empty(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _whole_groups(batches: Iterator[pa.RecordBatch], read) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups; ``read`` makes arrays of a batch, the two keys first."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = read(batch)
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        # The last group may go on in the next batch.
        last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        whole = int(last[-1]) + 1 if last.size else 0
        if whole:
            yield [x[:whole] for x in now]
        held = [x[whole:] for x in now]
    if held is not None:
        yield held


_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _put(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    # A pair that meets in several groups of the batch is put out once.
    pairs = np.unique(np.stack((u, v), axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, i].copy().view(np.int64)) for i in (0, 1)], schema=_LINK)


def _group_links(rule: Rule):
    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64) for name in ("mask", "value", "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mask, value, fp in _whole_groups(batches, read):
            a, b = _links([mask, value], fp[:, None], [rule.most])
            yield _put(fp[a], fp[b])

    return run


def _proposals(rule: Rule):
    """Pairs of nodes that ``rule`` proposes and that tie each group together."""

    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        keys = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("part", "value", "node")]
        prints = np.frombuffer(b"".join(batch.column("prints").to_pylist()), np.uint64).reshape(-1, rule.words)
        return [*keys, prints]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, value, node, prints in _whole_groups(batches, read):
            a, b = _links([part, value], prints, [CLOSE, rule.most])
            # A pair counts in the first part that it shares: there the same texts are tied together.
            first = _first_part(rule, prints[a] ^ prints[b]) == part[a] % (64 * rule.searched)
            a, b = a[first], b[first]
            yield _put(np.minimum(node[a], node[b]), np.maximum(node[a], node[b]))

    return run


def _first_part(rule: Rule, apart: np.ndarray) -> np.ndarray:
    """The lowest part (64 * word + left out bit) in which fingerprints that differ in ``apart`` meet, for each row."""
    found = np.full(len(apart), np.iinfo(np.int64).max)
    for w in range(rule.searched):
        for lo, hi in rule.cuts():
            own = apart[:, w] & np.uint64(_mask(range(lo, hi)))
            bits = np.bitwise_count(own)
            # Equal segments meet whichever bit is left out; one differing bit must be that one.
            out = np.where(bits == 1, np.bitwise_count(own - (bits == 1)), lo)
            found = np.where(bits <= 1, np.minimum(found, 64 * w + out.astype(np.int64)), found)
    return found


def _would_propose(rule: Rule, prints: np.ndarray) -> np.ndarray:
    """The matrix of pairs of ``prints`` that ``rule`` proposes."""
    apart = prints[:, None] ^ prints[None, :]
    near = np.bitwise_count(apart).sum(axis=2, dtype=np.int64) <= rule.most
    masks = [np.uint64(_mask(range(lo, hi))) for lo, hi in rule.cuts()]
    met = np.any([np.bitwise_count(apart[:, :, w] & m) <= 1 for w in range(rule.searched) for m in masks], axis=0)
    return near & met


def common_counts(sets: Sequence[np.ndarray], step: int = 8192) -> np.ndarray:
    """Exact numbers of common members of all pairs of ``sets`` (each without repeats)."""
    n, sizes = len(sets), [len(x) for x in sets]
    _, member, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    # Members of one set only count on the diagonal, which nobody asks for.
    shared_by = np.flatnonzero(times > 1)
    place = np.full(len(times), -1)
    place[shared_by] = np.arange(len(shared_by))
    held = place[member]
    owner, held = owner[held >= 0], held[held >= 0]
    counts = np.zeros((n, n), np.float32)
    for low in range(0, len(shared_by), step):
        now = (held >= low) & (held < low + step)
        table = np.zeros((n, step), np.float32)
        table[owner[now], held[now] - low] = 1
        counts += table @ table.T
    return counts


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the symmetric matrix ``linked`` that hold together what it holds together."""
    left, right, waiting = [], [], np.arange(len(linked))
    while waiting.size:
        frontier, waiting = [waiting[0]], waiting[1:]
        while frontier and waiting.size:
            one = frontier.pop()
            now = linked[one, waiting]
            reached = waiting[now]
            left += [one] * len(reached)
            right += reached.tolist()
            frontier += reached.tolist()
            waiting = waiting[~now]
    return np.array(left, np.int64), np.array(right, np.int64)


def _block_links(rule: Rule):
    """Links between different parts within each pair of blocks, as a forest."""

    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        keys = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("root", "cell", "own", "node", "label")]
        prints = np.frombuffer(b"".join(batch.column("prints").to_pylist()), np.uint64).reshape(-1, rule.words)
        sets = np.empty(batch.num_rows, object)
        sets[:] = [x.values.to_numpy() for x in batch.column("shingles")]
        return [*keys, prints, sets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for root, cell, own, node, label, prints, sets in _whole_groups(batches, read):
            for at, size in zip(*_groups(root, cell)):
                now = slice(at, at + size)
                asked = label[now, None] != label[None, now]
                if (own[now] != own[at]).any():
                    # Each block meets itself in a cell of its own.
                    asked &= own[now, None] != own[None, now]
                asked &= _would_propose(rule, prints[now])
                rows = np.flatnonzero(asked.any(axis=0))
                if rows.size:
                    own_sets = [sets[at + i] for i in rows]
                    common = common_counts(own_sets).astype(np.float64)
                    sizes = np.array([len(x) for x in own_sets])
                    alike = common >= rule.similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9
                    a, b = _forest(alike & asked[np.ix_(rows, rows)])
                    a, b = node[at + rows[a]], node[at + rows[b]]
                    yield _put(np.minimum(a, b), np.maximum(a, b))

    return run


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def variant_masks(rule: Rule) -> list[int]:
    """The 64 masks that keep one segment without one of its bits."""
    return [_mask(b for b in range(lo, hi) if b != out) for lo, hi in rule.cuts() for out in range(lo, hi)]


def refined_masks(mask: int, distance: int) -> list[int]:
    """``mask`` with each of ``distance`` + 1 parts of the bits that it leaves out."""
    rest = [b for b in range(64) if not mask >> b & 1]
    n = min(distance + 1, len(rest))
    return [mask | _mask(rest[len(rest) * i // n : len(rest) * (i + 1) // n]) for i in range(n)]


def links(distinct: DataFrame, scratch: shared.Scratch, rule: Rule, group_limit: int = 50_000) -> DataFrame:
    """Links (u, v) between one-word fingerprints ``fp`` of ``distinct`` that tie together all that link."""
    masks = variant_masks(rule)
    found = []
    rows = distinct.select("fp", F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask"))
    # A group can exceed the limit only if a segment's exact value is frequent: few counts per row.
    segments = F.array(*(F.lit(signed(_mask(range(lo, hi)))) for lo, hi in rule.cuts()))
    frequent = (
        distinct.select("fp", F.explode(segments).alias("mask"))
        .groupBy("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        .count()
        .where(F.col("count") > group_limit // 2)
    )
    large = not frequent.isEmpty()
    while True:
        now = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        if large:
            now = scratch.write(now)
            hot = scratch.write(now.groupBy("mask", "value").count().where(F.col("count") > group_limit))
            large = not hot.isEmpty()
        if large:
            # One row for each crowded mask, of which there are no more than masks of the round.
            crowded = [r["mask"] for r in hot.select("mask").distinct().collect()]
            finer = [(m, signed(r)) for m in crowded for r in refined_masks(m & (1 << 64) - 1, rule.most)]
            finer = distinct.sparkSession.createDataFrame(finer, "mask long, finer long")
            again = now.join(hot, ["mask", "value"], "left_semi")
            now = now.join(hot, ["mask", "value"], "left_anti")
        dealt = now.repartition("mask", "value").sortWithinPartitions("mask", "value")
        found.append(scratch.write(dealt.mapInArrow(_group_links(rule), "u long, v long").distinct()))
        if not large:
            break
        rows = scratch.write(again.join(finer, "mask").select("fp", F.col("finer").alias("mask")).distinct())
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _crowded(nodes: DataFrame, rows: DataFrame, scratch: shared.Scratch, rule: Rule, group_limit: int) -> DataFrame | None:
    """Groups (part, value, blocks) of ``rows`` above the limit, and the number of blocks to cut them into."""
    # A group can exceed the limit only if a segment's exact value is frequent: few counts per row.
    segments = [(w, signed(_mask(range(lo, hi)))) for w in range(rule.searched) for lo, hi in rule.cuts()]
    exact = F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"w{w}").bitwiseAND(F.lit(m)).alias("value")) for i, (w, m) in enumerate(segments)))
    counts = nodes.select(F.explode(exact).alias("at")).groupBy("at").count()
    if counts.where(F.col("count") > group_limit // 2).isEmpty():
        return None
    half = max(1, group_limit // 2)
    hot = rows.groupBy("part", "value").count().where(F.col("count") > group_limit)
    return scratch.write(hot.select("part", "value", F.ceil(F.col("count") / half).alias("blocks")))


def proposed(nodes: DataFrame, scratch: shared.Scratch, rule: Rule, group_limit: int) -> DataFrame:
    """Pairs (u, v) of ``nodes`` (node, prints, w0, w1...) that ``rule`` proposes, see ``_proposals``."""
    masks = [signed(m) for m in variant_masks(rule)]
    variants = F.array(*(
        F.struct(F.lit(w * len(masks) + i).cast("long").alias("part"), F.col(f"w{w}").bitwiseAND(F.lit(m)).alias("value"))
        for w in range(rule.searched) for i, m in enumerate(masks)
    ))
    rows = nodes.select("node", "prints", F.explode(variants).alias("at")).select("at.*", "node", "prints")
    hot = _crowded(nodes, rows, scratch, rule, group_limit)
    if hot is not None:
        # A member goes with its block to every pair of blocks that holds it; pairs are told apart by the part.
        dealt = rows.join(hot, ["part", "value"], "left").withColumn("n", F.coalesce("blocks", F.lit(1).cast("long")))
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        cell = F.least("own", "other") * F.col("n") + F.greatest("own", "other")
        rows = dealt.select((F.col("part") + cell * (rule.searched * len(masks))).alias("part"), "value", "node", "prints")
    dealt = rows.repartition("part", "value").sortWithinPartitions("part", "value", "node")
    return scratch.write(dealt.mapInArrow(shared.released(_proposals(rule)), "u long, v long").distinct())


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` whose shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    met = pairs.join(right, "v").join(left, "u")
    # Unlike sizes need no count of common shingles.
    met = met.where(F.least(F.size("a"), F.size("b")) >= similarity * F.greatest(F.size("a"), F.size("b")) - 1e-9)
    common = F.size(F.array_intersect("a", "b"))
    return met.where(common >= similarity * (F.size("a") + F.size("b") - common) - 1e-9).select("u", "v")


def similar_links(
    docs: DataFrame, nodes: DataFrame, scratch: shared.Scratch, rule: Rule, width: int, key: str, text: str, group_limit: int
) -> DataFrame:
    """Links (u, v) that tie together all ``nodes`` whose proposed pairs are similar."""
    pairs = proposed(nodes, scratch, rule, group_limit)
    tied = scratch.write(shared.components(pairs, scratch))
    sets = scratch.write(shingle_sets(docs, nodes.join(tied, "node", "left_semi").select("node", "row_a", "row_b"), width, key, text))
    good = scratch.write(similar(pairs, sets, rule.similarity))
    label = shared.components(good, scratch).select("node", F.col("root").alias("label"))
    parts = scratch.write(tied.join(label, "node", "left").select("node", "root", F.coalesce("label", "node").alias("label")))
    # What was tied by proposals and is not by links: its parts meet block by block.
    apart = parts.groupBy("root").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    left = scratch.write(parts.join(apart.select("root"), "root", "left_semi"))
    if left.isEmpty():
        return good
    rows = nodes.select("node", "prints").join(left, "node").join(sets, "node")
    dealt = block_pairs(rows, left).repartition("root", "cell").sortWithinPartitions("root", "cell", "node")
    return good.union(scratch.write(dealt.mapInArrow(shared.released(_block_links(rule)), "u long, v long").distinct()))


#: Texts of a block; two blocks and their shingles are in one task at a time.
BLOCK = 256


def block_pairs(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` (root, node, label ...) with their block ``own``, once for each ``cell`` of two blocks they are in.

    ``parts`` are (root, node, label) of the same rows. Rows of a root's largest part have blocks of
    their own, which do not meet each other.
    """
    sizes = parts.groupBy("root", "label").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("root").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("long")
    sizes = sizes.select(
        "root",
        F.col("main.label").alias("main"),
        blocks(F.col("main.n")).alias("first"),
        blocks(F.col("n") - F.col("main.n")).alias("others"),
    )
    dealt = rows.join(sizes, "root").withColumn("in_main", F.col("label") == F.col("main"))
    turn = F.xxhash64("node")
    own = F.when(F.col("in_main"), F.pmod(turn, "first")).otherwise(F.col("first") + F.pmod(turn, "others"))
    dealt = dealt.withColumn("own", own)
    lowest = F.when(F.col("in_main"), F.col("first")).otherwise(F.lit(0).cast("long"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(lowest, F.col("first") + F.col("others") - 1)))
    cell = F.least("own", "other") * (F.col("first") + F.col("others")) + F.greatest("own", "other")
    return dealt.withColumn("cell", cell).drop("main", "first", "others", "in_main", "other")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    rule: Rule = SIMILAR,
    key: str = "doc_id",
    text: str = "text",
    group_limit: int = 50_000,
) -> DataFrame:
    """One row per row of ``docs``: id, row key, fp, component_id (smallest id reachable over links).

    Intermediate tables are written when this is called.
    """
    scratch = shared.Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, width, rule, key, text))
    if rule.similarity is None:
        same = ["fp"]
        groups = rows.groupBy("fp").agg(F.min("id").alias("least")).withColumn("node", F.col("fp"))
        found = links(groups.select("fp"), scratch, rule, group_limit)
    else:
        same = ["set_a", "set_b"]
        # Equal sets have equal words.
        words = ["fp", *(f"w{i}" for i in range(1, rule.searched)), "prints"]
        groups = rows.groupBy(same).agg(
            F.min("id").alias("least"), F.min(F.struct("row_a", "row_b")).alias("row"), *(F.min(w).alias(w) for w in words)
        )
        # Numbers hold once they are written.
        groups = scratch.write(groups.withColumn("node", F.monotonically_increasing_id()))
        nodes = groups.select("node", "row.*", *words).withColumnRenamed("fp", "w0")
        found = similar_links(docs, nodes, scratch, rule, width, key, text, group_limit)
    tied = shared.components(found, scratch).withColumnRenamed("node", "tied")
    known = groups.join(tied, groups["node"] == tied["tied"], "left").select(
        *same, F.coalesce("root", "node").alias("root"), "least"
    )
    known = scratch.write(known)
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = known.join(smallest, "root").select(*same, "component_id")
    return rows.join(by_node, same).select("id", "row_a", "row_b", "fp", "component_id")


def kept(docs: DataFrame, width: int = 5, rule: Rule = SIMILAR) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id.

    Rows with the same doc_id and text are copies of one row; one of them stays. A row with a null
    doc_id stays only if no row of its group has an id, once for each text.
    """
    found = near_duplicates(docs, width, rule)
    stay = found.where(F.col("id").eqNullSafe(F.col("component_id"))).select("row_a", "row_b", "component_id")
    # Rows that share the smallest id may differ in text: one of them stays.
    without = F.when(F.col("component_id").isNull(), F.struct("row_a", "row_b")).alias("without")
    one = stay.groupBy("component_id", without).agg(F.min(F.struct("row_a", "row_b")).alias("row"))
    one = one.select("row.row_a", "row.row_b")
    row = shared.row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select(shared.packed(docs), *row)
    first = F.row_number().over(Window.partitionBy("row_a", "row_b").orderBy(F.lit(1)))
    copy = keyed.join(one, ["row_a", "row_b"], "left_semi").withColumn("copy", first)
    return copy.where("copy = 1").select(*shared.unpacked(docs).values())
