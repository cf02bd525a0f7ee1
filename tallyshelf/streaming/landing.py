"""Recurring crawl runs as a stream over their manifests.

A crawler lands a run as ``pages/run_id=<id>/`` and writes a manifest last, so a manifest
means the run is whole. The stream reads manifests; the pages of the runs in a batch are
read from their own partitions. Page rules therefore always see complete runs and need no
watermark and no state across runs. Pages landed after the manifest was closed are counted
and left out. Results become visible by a manifest too: see ``land_runs`` and ``landed``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyshelf import session
from tallyshelf.operators import metrics
from tallyshelf.plans import catalogue
from tallyshelf.plans.schemas import CATALOGUE
from tallyshelf.sources import crawl

MANIFEST_TYPE = "run_id STRING, run_ts TIMESTAMP, closed_at TIMESTAMP"
PAGE_TYPE = (
    "category STRING, page_no INT, url STRING, status INT, content_type STRING, html STRING, "
    "landed_at TIMESTAMP, run_id STRING"
)
KEYS = ("run_id", "category")
#: What a batch stores, without the folder columns ``run_id`` and ``attempt``.
STORED = {
    "snapshot": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATALOGUE.fields),
    "late": "late_pages BIGINT",
}


def manifests(spark: SparkSession, location: str, runs_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(MANIFEST_TYPE).option("maxFilesPerTrigger", runs_per_batch).json(location)


def _file_system(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _exists(spark: SparkSession, location: str) -> bool:
    files, path = _file_system(spark, location)
    return files.exists(path)


def run_pages(spark: SparkSession, location: str, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages landed in time, pages landed late) of the given runs.

    Only the folders of these runs are listed and read; a run without a folder has no pages.
    """
    ids = [r["run_id"] for r in runs.select("run_id").distinct().collect()]  # the runs of one batch
    folders = [f for f in (f"{location}/run_id={i}" for i in ids) if _exists(spark, f)]
    if folders:
        pages = spark.read.schema(PAGE_TYPE).option("basePath", location).parquet(*folders)
    else:
        pages = spark.createDataFrame([], PAGE_TYPE)
    pages = pages.withColumn("run_id", F.col("run_id").cast("string"))
    joined = pages.join(runs.select("run_id", "closed_at"), "run_id")
    # A page or run without a time counts as landed in time.
    late = F.coalesce(F.col("landed_at") > F.col("closed_at"), F.lit(False))
    return joined.filter(~late).drop("closed_at"), joined.filter(late).drop("closed_at")


def _publish(spark: SparkSession, output: str, runs: Sequence[str], attempt: str) -> None:
    """Make an attempt's rows the rows of its runs: one small file, numbered after the ones before it.

    The file gets its name when it is whole, so readers see all of the attempt or nothing.
    """
    files, folder = _file_system(spark, f"{output}/published")
    files.mkdirs(folder)
    # One file a batch, only their names are listed.
    before = [f.getPath().getName() for f in files.listStatus(folder)]
    number = max((int(n.split("-")[0]) for n in before if n[0].isdigit()), default=0) + 1
    whole = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}-{attempt}.json")
    begun = spark._jvm.org.apache.hadoop.fs.Path(folder, f"_{attempt}.tmp")
    stream = files.create(begun, True)
    stream.write("".join(json.dumps({"run_id": r, "attempt": attempt}) + "\n" for r in runs).encode())
    stream.close()
    if not files.rename(begun, whole):
        raise OSError(f"could not publish {whole.toString()}")


def published(spark: SparkSession, output: str) -> DataFrame:
    """``run_id, attempt``: the attempt that holds each run's rows, the last one that was published."""
    if not _exists(spark, f"{output}/published"):
        return spark.createDataFrame([], "run_id STRING, attempt STRING")
    said = spark.read.schema("run_id STRING, attempt STRING").json(f"{output}/published")
    named = said.select("run_id", "attempt", F.col("_metadata.file_name").alias("file"))
    return named.groupBy("run_id").agg(F.max_by("attempt", "file").alias("attempt"))


def _valid(spark: SparkSession, output: str) -> set[str]:
    """Attempts that hold some run's rows: one name a batch at most."""
    return {r["attempt"] for r in published(spark, output).select("attempt").distinct().collect()}


def landed(spark: SparkSession, output: str, kind: str = "snapshot") -> DataFrame:
    """The published rows of all runs: ``snapshot``, or ``late`` for counts of late pages.

    Only the folders of attempts that hold a run are listed and read.
    """
    stored, valid = f"{STORED[kind]}, run_id STRING, attempt STRING", sorted(_valid(spark, output))
    if not valid:
        return spark.createDataFrame([], stored).drop("attempt")
    folders = [f"{output}/{kind}/attempt={a}" for a in valid]
    rows = spark.read.schema(stored).option("basePath", f"{output}/{kind}").parquet(*folders)
    return rows.join(published(spark, output), ["run_id", "attempt"], "left_semi").drop("attempt")


def discard_unpublished(spark: SparkSession, output: str) -> None:
    """Delete attempts that hold no run any more: failed, killed or replaced ones. Not for use while a batch runs."""
    valid = _valid(spark, output)
    for kind in STORED:
        files, folder = _file_system(spark, f"{output}/{kind}")
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("attempt=") and name.removeprefix("attempt=") not in valid:
                files.delete(status.getPath(), True)


def land_runs(
    runs: DataFrame, pages_at: str, output: str, seeds: DataFrame, base_url: Column | str, metrics_table: str | None = None
) -> None:
    """Process whole runs and publish them.

    A batch writes its rows to a folder of its own, an attempt, and publishes it at the end. Until then, and if
    the batch fails or is killed, readers of ``landed`` see each run as it was. A batch that is retried
    replaces the rows of its runs; a run that has no rows now has none then. With ``metrics_table``
    the batch's counters are added there, under the attempt. Scratch tables are deleted at its end.
    """
    spark, attempt = runs.sparkSession, uuid.uuid4().hex
    tally = metrics.Tally()
    with session.scratch_scope(spark):
        _land(runs, pages_at, output, attempt, seeds, base_url, tally)
    ids = [r["run_id"] for r in runs.select("run_id").distinct().collect()]  # the runs of one batch
    _publish(spark, output, ids, attempt)
    if metrics_table:
        metrics.append_run(tally, spark, metrics_table, attempt)


def _land(
    runs: DataFrame, pages_at: str, output: str, attempt: str, seeds: DataFrame, base_url: Column | str, tally: metrics.Tally
) -> None:
    spark = runs.sparkSession
    in_time, late = run_pages(spark, pages_at, runs)
    usable = in_time.filter(crawl.is_html_response(F.col("status"), F.col("content_type")))
    rows = catalogue.scan_result(catalogue.page_tiles(usable, seeds, base_url, KEYS, tally=tally), KEYS, tally=tally)
    stamped = rows.join(runs.select("run_id", "run_ts"), "run_id")
    snapshot = stamped.select(
        F.date_trunc("second", "run_ts").alias("ts"),
        catalogue.text.category_label(F.col("category")).alias("category"),
        *[c for c in CATALOGUE.names if c not in ("ts", "category")],
        "run_id",
    )
    counted = tally.watch("late pages", late).groupBy("run_id").agg(F.count("*").alias("late_pages"))
    for kind, kept in (("snapshot", tally.watch("snapshot", snapshot)), ("late", counted)):
        kept.write.partitionBy("run_id").parquet(f"{output}/{kind}/attempt={attempt}")


def catalogue_stream(
    spark: SparkSession,
    landing: str,
    output: str,
    seeds: DataFrame,
    base_url: Column | str,
    runs_per_batch: int = 16,
    metrics_table: str | None = None,
) -> StreamingQuery:
    """Process every run whose manifest is new since the last call, then stop. Read it with ``landed``."""

    def batch(runs: DataFrame, _: int) -> None:
        runs = runs.dropDuplicates(["run_id"])
        land_runs(runs, f"{landing}/pages", output, seeds, base_url, metrics_table)

    return (
        manifests(spark, f"{landing}/manifests", runs_per_batch)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", f"{output}/_stream")
        .trigger(availableNow=True)
        .start()
    )
