"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

Every source's documents are shuffled (by a hash of the document id), laid end to end as a stream of
words, and cut into blocks of ``block_words`` words; the stream may be walked twice. A source needs
as many slots as blocks to reach its target, the last one cut short. Of Q slots in all, slot k has
the point k * a mod Q with a next to Q divided by the golden ratio and prime to Q: a golden-ratio
sequence on a lattice, which meets every point exactly once. Sources lie end to end on the points,
each as wide as its slots, so every prefix of the schedule is close to the weights and every source
gets exactly its slots. Slots are ranked within their source, and rank r is joined to block r.

Targets: sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all
words; no target exceeds ``most`` times its source's words, the excess is shared by weight again.

Scale: documents, blocks and slots are dealt by (source, block) or (source, part); offsets and ranks
are sums per part first, then within the part, so no source is ever in one task. Only tables with
one row per source or per (source, part) are summed in order. Two numbers come to the driver.

Defined cases: a null text has size 0; a document of size 0 is in no block and takes 0; a null
source is a source of its own; rows with the same id and size stand next to each other and are told
apart by their place only; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyshelf.llm import shared

WORD = r"[^\x20\x09-\x0D]+"
#: Parts of a source's documents, by the leading hex digits of the shuffle key.
_PART_DIGITS = 3
#: Slots ranked together within a source.
_SLOT_PART = 1 << 16


def words(text: Column) -> Column:
    return F.regexp_count(shared.whole(text), F.lit(WORD)).cast("long")


def shuffle_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, target.

    The share of a weight unit is the same for all sources that are not at their limit; sources reach
    their limit in the order of limit by weight, so running sums give a share for each number of full sources;
    of those that leave the next source below its limit the largest is the one that fills no source in vain.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    weighed = totals.select(
        "*", F.get(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))).alias("weight")
    )
    weighed = weighed.select("*", (F.lit(float(most)) * F.col("source_size") / F.col("weight")).alias("full_at"))
    every = Window.partitionBy()
    by_limit = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    running = weighed.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(every)).alias("all_words"),
        F.coalesce(F.sum("source_size").over(by_limit) * F.lit(most), F.lit(0)).alias("limited"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0.0))).alias("weight_left"),
    )
    unit = (F.col("all_words") - F.col("limited")) / F.col("weight_left")
    found = running.select("*", F.max(F.when(unit <= F.col("full_at"), unit)).over(every).alias("unit"))
    limit = F.lit(float(most)) * F.col("source_size")
    return found.select(
        "source", "source_size", F.coalesce(F.least(limit, F.col("unit") * F.col("weight")), limit).alias("target")
    )


def lattice_step(slots: int) -> int:
    """The number next to slots / golden ratio that is prime to ``slots``."""
    step = max(1, round(slots * (5**0.5 - 1) / 2))
    while gcd(step, slots) != 1:
        step += 1
    return step


def _times_mod(k: Column, step: int, modulus: int) -> Column:
    """k * step mod modulus without leaving 64 bits, for a modulus below 2^39."""
    high, low = F.shiftright(k, 16), k.bitwiseAND(F.lit(0xFFFF))
    return F.pmod(F.pmod(high * F.lit(step), F.lit(modulus)) * F.lit(1 << 16) + low * F.lit(step), F.lit(modulus))


def schedule(quotas: DataFrame, slots: int, n_sources: int) -> DataFrame:
    """(slot, source, block): ``quotas`` (source, quota, first: where the source lies on the points)."""
    spark = quotas.sparkSession
    width = max(1, slots // (4 * max(1, n_sources)))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), _times_mod(F.col("id"), lattice_step(max(1, slots)), max(1, slots)).alias("point")
    )
    points = points.withColumn("cell", F.floor(F.col("point") / F.lit(width)))
    # A cell holds few sources, as there are at least as many cells; a point looks at its cell's only.
    spans = quotas.where("quota > 0").select(
        "source",
        "first",
        (F.col("first") + F.col("quota")).alias("end"),
        F.explode(
            F.sequence(F.floor(F.col("first") / width), F.floor((F.col("first") + F.col("quota") - 1) / width))
        ).alias("cell"),
    )
    placed = points.join(spans, "cell").where("point >= first AND point < end").select("slot", "source")
    placed = placed.withColumn("part", F.shiftright("slot", 16))
    counts = placed.groupBy("source", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    within = Window.partitionBy("source", "part").orderBy("slot")
    ranked = placed.withColumn("rank", F.row_number().over(within) - 1)
    joined = ranked.join(counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return joined.select("slot", "source", (F.col("rank") + F.col("ahead")).alias("block"))


def _placed(base: DataFrame) -> DataFrame:
    """``base`` (source, size, shuffle) with ``start``: words of the source before the row."""
    part = F.substring("shuffle", 1, _PART_DIGITS)
    keyed = base.withColumn("part", part)
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    within = Window.partitionBy("source", "part").orderBy("shuffle", "doc_id", "size", "row_a", "row_b")
    running = keyed.withColumn("upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    running = running.withColumn("nth", F.row_number().over(within))
    joined = running.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return joined.select(*base.columns, "nth", (F.col("ahead") + F.col("upto") - F.col("size")).alias("start"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    block_words: int = 2048,
    seed: str = "mix-",
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The plan (a row per document) and the schedule (a row per piece of a document in a slot).

    Plan: doc_id, row_a, row_b, size, source, source_size, target, taken. Schedule: slot, source,
    block, doc_id, row_a, row_b, nth, words. Intermediate tables are written when this is called.
    """
    spark = docs.sparkSession
    scratch = shared.Scratch(spark, "mixture")
    id_, source_, text_ = F.col(key), F.col(source), F.col(text)
    base = scratch.write(
        docs.select(
            id_.alias("doc_id"),
            source_.alias("source"),
            words(text_).alias("size"),
            shuffle_key(id_, seed).alias("shuffle"),
            *shared.row_key(id_, source_, text_),
        )
    )
    goal = targets(base, weights, share, most)
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    goal = goal.select("*", wanted.alias("wanted"), F.ceil(wanted / F.lit(block_words)).cast("long").alias("quota"))
    # One row per source.
    order = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    goal = scratch.write(goal.select("*", F.coalesce(F.sum("quota").over(order), F.lit(0)).alias("first")))
    slots, n_sources = goal.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()
    slot_table = schedule(goal, slots, n_sources)

    placed = scratch.write(_placed(base))
    goals = goal.select(F.col("source").alias("s"), "source_size", "target", "wanted")
    with_goal = placed.join(goals, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # The stream is walked up to ``most`` times; a walk's pieces end where the source's wanted words end.
    walks = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    laid = with_goal.where("size > 0").select("*", walks.alias("walk"))
    laid = laid.withColumn("lo", F.col("start") + F.col("walk") * F.col("source_size"))
    laid = laid.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("wanted"))).where("lo < hi")
    block = F.col("block")
    pieces = laid.select(
        "source", "doc_id", "row_a", "row_b", "nth", "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words))).alias("block"),
    )
    pieces = pieces.select(
        F.col("source").alias("s"), F.col("block").alias("b"), "doc_id", "row_a", "row_b", "nth",
        (F.least("hi", (block + 1) * block_words) - F.greatest("lo", block * block_words)).alias("words"),
    )
    mixed = slot_table.join(pieces, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    mixed = mixed.select("slot", "source", "block", "doc_id", "row_a", "row_b", "nth", "words")

    names = ["row_a", "row_b", "nth"]
    got = mixed.groupBy(*names).agg(F.sum("words").alias("taken"))
    plan = with_goal.join(got, names, "left")
    plan = plan.select(
        "doc_id", *names, "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )
    return plan, mixed


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with every document as often as the mix takes it.

    A document of which the mix takes a part stands once for every whole walk, and once more if at
    least half of its words are taken in the last one; a document that is not taken goes, and so does
    one without words. Columns are those of ``docs``.
    """
    plan, _ = mix(docs, **parameters)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    # Rows with the same content share their key: their copies are listed and dealt out by number.
    plan = plan.where("taken > 0").groupBy("row_a", "row_b").agg(F.sort_array(F.collect_list(copies), False).alias("copies"))
    row = shared.row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    keyed = docs.select(shared.packed(docs), *row)
    number = F.row_number().over(Window.partitionBy("row_a", "row_b").orderBy(F.lit(1)))
    joined = keyed.join(plan, ["row_a", "row_b"]).withColumn("number", number)
    times = F.coalesce(F.get("copies", F.col("number") - 1), F.lit(0))
    return joined.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times))).select(*shared.unpacked(docs).values())
