"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Time columns are defined in UTC, and HTML rows are
# large, so Arrow batches are bounded by bytes as well as by rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide projections make one generated method per stage too long for the JVM to compile;
    # past this size Spark splits the work into per-expression methods that do get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Page scripts repeat keys; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
}


_written: list[str] = []
_shipped: set[str] = set()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what every job relies on and make this package importable on the executors.

    The settings hold for the whole session; give the jobs a session of their own
    (``spark.newSession()``) where others must not meet them.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    _ship_package(spark.sparkContext)
    return spark


def _ship_package(context: SparkContext) -> None:
    """Give the package to the Python workers, once per application."""
    if context.applicationId not in _shipped:
        home = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="tallyshelf-package-")) / home.name
        context.addPyFile(shutil.make_archive(str(target), "zip", home.parent, home.name))
        _shipped.add(context.applicationId)


def local_session(cores: str | int = "*", app: str = "tallyshelf") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # Small tables are read in several parts too.
        .config("spark.sql.files.maxPartitionBytes", str(2 * 1024 * 1024))
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tallyshelf-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall back to a
    temporary folder; a cluster without the setting is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tallyshelf-scratch-")


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that hold within the block only."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# For rows landed by folder. A few writers are open per task instead of sorting its rows by their folder, which would
# put all of them on disk once more; past that number Spark sorts. Their row groups are small, for the memory they
# take together. What was shuffled for the write goes with its end; nothing else reads it.
_BY_FOLDER = {
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_SMALL_GROUPS = {"parquet.block.size": str(32 * 1024 * 1024)}


def written(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), files: int | None = None, codec: str | None = None
) -> DataFrame:
    """Write ``df`` once as parquet under the scratch root and read it back; ``files`` deals its rows to so many files.

    Used where several branches need one expensive result (parsed pages). The files outlive
    executors, keep column pruning, and give the planner an exact size for join choices.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    dealt = df if files is None else df.repartition(files)
    options = (_SMALL_GROUPS if partition_by else {}) | ({"compression": codec} if codec else {})
    with _set(spark, _BY_FOLDER if partition_by else {}):
        dealt.write.options(**options).partitionBy(*partition_by).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_written(spark: SparkSession) -> None:
    """Delete this process's scratch tables; call when the results built on them are stored."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the scratch tables written within; for jobs that store their results."""
    outside = list(_written)
    _written.clear()
    try:
        yield
    finally:
        release_written(spark)
        _written.extend(outside)


def plan_bytes(df: DataFrame) -> int:
    """Planner's size estimate; exact file size for a plain or freshly written scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.lstrip("-").isdigit():
        return int(limit)
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit))


def sized(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a size the planner knows; one made from driver rows has none until written."""
    return df if plan_bytes(df) < 2**62 else written(df, name)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the known size of ``df`` is within the session's broadcast limit."""
    return plan_bytes(df) <= broadcast_limit(df.sparkSession)
