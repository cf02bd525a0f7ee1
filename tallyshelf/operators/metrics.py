"""Run metrics as small aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallyshelf.operators import sinks


def counts_by(rows: DataFrame, keys: Sequence[str], **conditions: Column) -> DataFrame:
    """Rows per group, and per named condition the rows that meet it."""
    wanted = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), *wanted)


def error_tally(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("scrape_error").agg(F.count("*").alias("rows"))


def page_metrics(tiles: DataFrame, firsts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per page: tiles found and URLs seen for the first time."""
    found = tiles.groupBy(*keys, "page_no").agg(F.count("*").alias("found"))
    new = firsts.groupBy(*keys, F.col("first_page").alias("page_no")).agg(F.count("*").alias("new_urls"))
    return found.join(new, [*keys, "page_no"], "left").select(
        *keys, "page_no", "found", F.coalesce("new_urls", F.lit(0).cast("bigint")).alias("new_urls")
    )


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written; read ``observation.get`` after the write."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class Tally:
    """Counters of one run, filled by the writes that the run does anyway.

    ``watch`` a frame before it is written; when its write is done, the counters are there. They cost no pass
    of their own. A stage that Spark repeats because an executor was lost may count its rows twice; the
    tables themselves are not touched by that.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, step: str, rows: DataFrame, **counters: Column) -> DataFrame:
        """``rows``, counted by the named aggregates, else as ``rows``, under a step name used once a run."""
        if step in self._seen:
            raise ValueError(f"step {step} is counted already")
        self._seen[step] = Observation()
        wanted = [F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).alias(name) for name, c in counters.items()]
        return rows.observe(self._seen[step], *(wanted or [F.count(F.lit(1)).alias("rows")]))

    def frame(self, spark: SparkSession, run: str, run_ts: str | None = None) -> DataFrame:
        """One row per step and counter; call it when all watched frames are written."""
        found = [(run, step, name, n) for step, seen in self._seen.items() for name, n in seen.get.items()]
        made = spark.createDataFrame(found, "run STRING, step STRING, counter STRING, value BIGINT")
        stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
        return made.select("run", F.date_trunc("second", stamp).alias("run_ts"), "step", "counter", "value")


def append_run(tally: Tally, spark: SparkSession, table: str, run: str, run_ts: str | None = None) -> None:
    """Add a run's counters to the metrics table, which is made at its first run."""
    rows = tally.frame(spark, run, run_ts)
    sinks.create_if_missing(spark, table, rows.schema)
    rows.coalesce(1).write.mode("append").insertInto(table)
