"""Sharding by a minimax contiguous partition; DataFrame functions only.

Documents with equal texts are one atomic group. Groups stand in the order of a digest of their text
(60 bits of its MD5) and are cut into ``shards`` runs so that the largest run is as small as any such
cut allows: a binary search finds the smallest capacity with which greedy filling needs no more than
``shards`` runs, and the groups are cut where that filling cuts them. A shard is thus a range of
digests, and the shard of a row follows from its own text and at most ``shards`` - 1 keys.

The search needs no list of all groups. Spark sums sizes over leading bits of the digest, 4,096 sums at
first. Filling whole sums only, and filling as if sums could be cut anywhere, bound the capacity and
every cut from both sides; only sums between the bounds of some cut, and sums too large to be placed
whole, are split by further bits in the next job, until both fillings agree. The driver sees the
sums, about ``most_sums`` at once, whatever the size of the corpus; it never sees groups elsewhere.

Slots: rows are ranged by (digest, digest of the id), so a group of copies spreads over tasks, and
numbered within their task; only one row per task and shard is summed in order.

Size: UTF-8 bytes of the text plus ``overhead``.

Defined cases: a null text is an empty text; rows with the same id and text share a shard and get
different slots in any order; fewer groups than shards leave the last shards empty; an empty table
gives an empty result; a null id is ordered as an empty one; other columns are carried along.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyshelf.llm import shared

#: Bits of a key; two texts that share them are kept together.
KEY_BITS = 60
_FIRST_BITS = 12


@dataclass(frozen=True)
class Sums:
    """Bytes of the groups whose keys begin with ``prefix``; ``whole`` if that is one group."""

    level: int
    prefix: int
    size: int
    first: int
    whole: bool


def _digest(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, KEY_BITS // 4), 16, 10).cast("long")


def _prefix(level: int) -> Column:
    return F.shiftright("key", KEY_BITS - level)


def _summed(rows: DataFrame, level: Column, prefix: Column) -> list[Sums]:
    found = rows.select(level.alias("level"), prefix.alias("prefix"), "key", "size").where("level IS NOT NULL")
    sums = found.groupBy("level", "prefix").agg(F.sum("size"), F.min("key"), F.max("key"))
    return [Sums(*r[:4], r[3] == r[4]) for r in sums.collect()]


def _split(rows: DataFrame, wide: Sequence[Sums], most_sums: int) -> list[Sums]:
    """Finer sums in place of ``wide``, by as many further bits as ``most_sums`` allows."""
    more = max(1, (most_sums // len(wide)).bit_length() - 1)
    by_level = defaultdict(list)
    for s in wide:
        by_level[s.level].append(s.prefix)
    level, prefix = F.lit(None).cast("int"), F.lit(None).cast("long")
    for old, prefixes in by_level.items():
        new = min(KEY_BITS, old + more)
        inside = _prefix(old).isin(prefixes)
        level, prefix = F.when(inside, F.lit(new)).otherwise(level), F.when(inside, _prefix(new)).otherwise(prefix)
    return _summed(rows, level, prefix)


def fill(sums: Sequence[Sums], ends: Sequence[int], capacity: int, shards: int, divisible: bool) -> list[int]:
    """Bytes filled after each shard; ``divisible``: sums of several groups may be cut anywhere."""
    filled, at = [], 0
    for _ in range(shards):
        i = bisect_right(ends, at + capacity)
        end = ends[i - 1] if i else 0
        if divisible and i < len(ends) and not sums[i].whole:
            end = at + capacity
        at = max(at, end)
        filled.append(at)
    return filled


def smallest_capacity(sums: Sequence[Sums], ends: Sequence[int], shards: int, divisible: bool) -> int:
    low, high = -(-ends[-1] // shards), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if fill(sums, ends, middle, shards, divisible)[-1] >= ends[-1]:
            high = middle
        else:
            low = middle + 1
    return low


def cut_keys(rows: DataFrame, shards: int, most_sums: int = 1 << 14) -> list[int]:
    """Keys at which shard 1, 2, ... begin, of ``rows`` (key, size: long)."""
    sums = _summed(rows, F.lit(_FIRST_BITS), _prefix(_FIRST_BITS))
    while sums:
        sums.sort(key=lambda s: s.first)
        ends = list(accumulate(s.size for s in sums))
        open_sums = [s for s in sums if not s.whole and s.level < KEY_BITS]
        wide = [s for s in open_sums if s.size * 64 * shards > ends[-1]]
        if not wide:
            low = smallest_capacity(sums, ends, shards, True)
            high = smallest_capacity(sums, ends, shards, False)
            least, most = fill(sums, ends, low, shards, False), fill(sums, ends, high, shards, True)
            if low == high and least == most:
                return [sums[bisect_right(ends, end)].first for end in least if end < ends[-1]]
            between = {i for a, b in zip(least, most) for i in range(bisect_right(ends, a), min(len(ends) - 1, bisect_left(ends, b)) + 1)}
            wide = [s for s in (sums[i] for i in sorted(between)) if not s.whole and s.level < KEY_BITS]
        gone = {(s.level, s.prefix) for s in wide}
        sums = [s for s in sums if (s.level, s.prefix) not in gone] + _split(rows, wide, most_sums)
    return []


def shard_of(key: Column, cuts: Sequence[int]) -> Column:
    """The shard of a row with ``key``: the number of cuts at or below it."""
    return sum((F.when(key >= cut, 1).otherwise(0) for cut in cuts), F.lit(0)).cast("int")


def sharded(
    docs: DataFrame, shards: int = 24, text: str = "text", doc_id: str = "doc_id", overhead: int = 8, keep_text: bool = True
) -> DataFrame:
    """(doc, size, text_crc32, shard, slot) of every row; ``doc`` is packed by ``shared.packed``.

    Intermediate tables are written when this is called. Without ``keep_text`` the text is not moved
    and is missing in ``doc``.
    """
    scratch = shared.Scratch(docs.sparkSession, "shards")
    body = shared.whole(F.col(text))
    rows = scratch.write(
        docs.select(
            shared.packed(docs, but=[] if keep_text else [text]),
            (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            _digest(body).alias("key"),
            _digest(shared.whole(F.col(doc_id))).alias("turn"),
        )
    )
    cuts = cut_keys(rows, shards)
    ordered = rows.repartitionByRange("key", "turn").sortWithinPartitions("key", "turn")
    placed = scratch.write(
        ordered.select(
            "doc", "size", "text_crc32", shard_of(F.col("key"), cuts).alias("shard"), F.monotonically_increasing_id().alias("at")
        )
    )
    task = F.shiftright("at", 33)
    runs = placed.groupBy("shard", task.alias("task")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    # One row per task of the ranged table and shard in it.
    found = placed.withColumn("task", task).join(F.broadcast(runs), ["shard", "task"])
    return found.select("doc", "size", "text_crc32", "shard", (F.col("at") + F.col("shift")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, text: str = "text", doc_id: str = "doc_id") -> None:
    """Whole rows of ``docs`` as Parquet under ``path``, one folder ``shard=N`` each, in the order of their slots.

    Columns of ``docs`` stand in a struct ``doc`` by their numbers (``shared.unpacked`` names them again), so
    that none can clash with ``shard`` and ``slot``.
    """
    found = sharded(docs, shards, text, doc_id)
    found.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
