"""Helpers of the operators in this folder: session, row keys, scratch tables, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyshelf import session

# Rows of an Arrow batch; long texts are bounded by bytes instead.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
}


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the package, with Arrow batches for narrow rows as well as long texts."""
    session.apply_settings(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def every(df: DataFrame, *, but: Iterable[str] = ()) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    left_out = set(but)
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in left_out]


def packed(df: DataFrame, *, but: Iterable[str] = ()) -> Column:
    """A struct ``doc`` of the columns, numbered, so that no name can clash with an operator's own."""
    return F.struct(F.lit(0).alias("no"), *(c.alias(f"c{i}") for i, c in enumerate(every(df, but=but)))).alias("doc")


def unpacked(df: DataFrame, *, but: Iterable[str] = ()) -> dict[str, Column]:
    """The columns of ``df`` back from ``packed(df, but=but)``, by name and in order."""
    left_out = set(but)
    names = [c for c in df.columns if c not in left_out]
    return {n: F.col("doc").getField(f"c{i}").alias(n) for i, n in enumerate(names)}


def row_key(*columns: Column) -> list[Column]:
    """128 bits that name a row by its content; rows with the same key are copies of one row."""
    return [
        F.xxhash64(F.lit(11), *columns).alias("row_a"),
        F.xxhash64(F.lit("second"), *columns).alias("row_b"),
    ]


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over Arrow batches, after which the worker, which outlives its task, gives free memory back."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped


class Scratch:
    """Tables of one operator run in the cluster's shared folder.

    A written table cuts lineage and outlives executors; ``drop`` removes one that nothing reads
    any more, so that an iterative operator holds two generations at most.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{session.scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def write(self, df: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in tables:
            for file in df.inputFiles()[:1]:
                number = file.split(self.root.rsplit("/", 1)[-1] + "/", 1)[1].split("/", 1)[0]
                path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{number}")
                path.getFileSystem(conf).delete(path, True)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges`` (u, v: long): one row (node, root), root the smallest node.

    Alternating large-star and small-star steps. Each step is a minimum per node (partially
    aggregated) and one join; a hub's rows are split by adaptive execution. Steps are written,
    and only a count and a checksum come to the driver. Self loops are allowed, nulls are not.
    """
    now = scratch.write(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    nodes = now.select(F.col("u").alias("node")).union(now.select(F.col("v").alias("node"))).distinct()
    nodes = scratch.write(nodes)
    seen = None
    while True:
        # Large star: every larger neighbour of a node is tied to the node's smallest neighbour.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.write(large.where("u <> v").distinct())
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        after = scratch.write(small.select("e.u", "e.v").where("u <> v").distinct())
        scratch.drop(now, large)
        now = after
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    roots = now.groupBy("u").agg(F.min("v").alias("root"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
