"""Table writers. Every overwrite writes a new version beside the old one, then lets the table name it."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from tallyshelf.operators.align import fit


def create_if_missing(
    spark: SparkSession, table: str, schema: StructType, partition_by: Sequence[str] = ()
) -> None:
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema)
        empty.write.partitionBy(*partition_by).saveAsTable(table)


def _versions(spark: SparkSession, table: str) -> str:
    """Folder of a table's versions: beside the tables of its database."""
    database, _, name = table.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{name}__versions"


def _stored_at(spark: SparkSession, table: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return detail["data_type"].rstrip("/")


def _file_system(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _remove(spark: SparkSession, location: str) -> None:
    files, path = _file_system(spark, location)
    files.delete(path, True)


def _forget(spark: SparkSession, versions: str, keep: set[str]) -> None:
    """Delete the versions that are not in ``keep``, leftovers of killed loads among them."""
    files, path = _file_system(spark, versions)
    for status in files.listStatus(path):
        if status.getPath().getName() not in keep:
            files.delete(status.getPath(), True)


def _new_version(df: DataFrame, table: str) -> str:
    """Write ``df`` as a version of its own that no table names yet; a failed write leaves none."""
    spark = df.sparkSession
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    spot = f"{_versions(spark, table)}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(spot)
    except Exception:
        _remove(spark, spot)
        raise
    return spot


def _install(spark: SparkSession, spot: str, table: str) -> None:
    """Let ``table`` name the finished version at ``spot``.

    Where the columns are the same this is one change in the catalogue (``SET LOCATION``): the table is there
    at all times, keeps its grants, and each query reads one version or the other. The version before it
    stays for queries that have begun. Other columns need a new table, made under another name and
    renamed. A partitioned table keeps its partitions and is overwritten in place.
    """
    columns = lambda df: [(f.name, f.dataType) for f in df.schema]
    made = spark.read.parquet(spot)
    versions, keep = _versions(spark, table), {spot.rsplit("/", 1)[-1]}
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{spot}'")
    elif any(c.isPartition for c in spark.catalog.listColumns(table)):
        made.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        keep.clear()
    elif columns(spark.table(table)) == columns(made):
        before = _stored_at(spark, table)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{spot}'")
        spark.catalog.refreshTable(table)
        keep.add(before.rsplit("/", 1)[-1])
    else:
        staged = f"{table}__new_{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE TABLE {staged} USING parquet LOCATION '{spot}'")
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    _forget(spark, versions, keep)


def replace_table(df: DataFrame, table: str, schema: StructType | None = None) -> None:
    """Create or replace; the rows are written once, as a version of their own.

    A load that fails or is killed leaves the table as it was, and what it has written is deleted by the next
    load. Column changes are allowed. One load of a table runs at a time. Other sessions that have the
    table in their cache see its old version until they refresh it, or until two loads later.
    """
    spot = _new_version(fit(df, schema) if schema is not None else df, table)
    _install(df.sparkSession, spot, table)


def guarded_overwrite(df: DataFrame, table: str, schema: StructType) -> int:
    """Overwrite unless the result is empty; returns rows written.

    The result is computed once, into its version, and counted there from the file footers.
    """
    spark = df.sparkSession
    spot = _new_version(fit(df, schema), table)
    rows = spark.read.parquet(spot).count()
    if rows:
        _install(spark, spot, table)
    else:
        _remove(spark, spot)
        warnings.warn(f"no rows collected; {table} keeps its previous snapshot", stacklevel=2)
    return rows


def append_snapshot(df: DataFrame, table: str, schema: StructType, time_column: str = "ts") -> None:
    """Add one run's rows; the table is partitioned by the day of the run. Nothing is merged.

    An empty run adds no rows; Spark finds that out while writing, without a second pass.
    """
    day = StructField("ts_date", DateType())
    stored = StructType([*schema.fields, day])
    create_if_missing(df.sparkSession, table, stored, ["ts_date"])
    rows = fit(df, schema).withColumn("ts_date", F.to_date(time_column))
    rows.write.mode("append").insertInto(table)


# A line break within a text is written as an escape, so that a row stays one line and files split.
_SHEET = {"header": True, "escape": '"', "emptyValue": ""}


def _one_line(c: Column) -> Column:
    escaped = F.replace(c.cast(StringType()), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def read_sheet(spark: SparkSession, location: str) -> DataFrame:
    """A text sheet as ``append_under_header`` wrote it."""
    raw = spark.read.options(**_SHEET).csv(location)
    pattern = F.lit(r"\\[\\nr]|[^\\]+|\\")
    whole = lambda c: F.array_join(
        F.transform(
            F.regexp_extract_all(c, pattern, F.lit(0)),
            lambda x: F.when(x == "\\n", "\n").when(x == "\\r", "\r").when(x == "\\\\", "\\").otherwise(x),
        ),
        "",
    )
    return raw.select(*[F.when(F.contains(F.col(f"`{c}`"), F.lit("\\")), whole(F.col(f"`{c}`"))).otherwise(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def header_of(spark: SparkSession, location: str) -> list[str] | None:
    """Column names of a text sheet; None when nothing is stored there yet."""
    try:
        stored = read_sheet(spark, location).columns
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return stored or None


def append_under_header(df: DataFrame, location: str, header: Sequence[str]) -> list[str]:
    """Append text rows to a CSV sheet; returns the header they were written under.

    A new sheet gets ``header``. Where the stored header differs, rows go in by position under
    the old one and a warning is raised; columns beyond a shorter header have no place and are
    left out, those that a longer one has in addition stay empty. ``read_sheet`` reads it back.
    """
    spark = df.sparkSession
    stored = header_of(spark, location)
    names = list(header) if stored is None else stored
    if stored is not None and stored != list(header):
        warnings.warn(f"sheet header differs from expected; appending by position: {stored}", stacklevel=2)
    cells = [_one_line(F.col(c)) for c in header][: len(names)]
    cells += [F.lit(None).cast(StringType())] * (len(names) - len(cells))
    shown = df.select(*[c.alias(n) for c, n in zip(cells, names)])
    shown.write.mode("append").options(**_SHEET).csv(location)
    return names


def write_tabs(
    frames: dict[str, DataFrame], tables: dict[str, str], prefix: str = "", at_once: int = 4
) -> dict[str, str]:
    """One table per tab, ``at_once`` tabs at a time; a tab that fails is reported and the others go on.

    Small tabs fill the cores that a large one leaves idle towards its end. Each tab is a scheduler pool of its
    own, so with ``spark.scheduler.mode=FAIR`` they share the cores evenly. Outcomes are in the tabs' order.
    """
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession

    def store(tab: str) -> str:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tab {tab}")
        try:
            replace_table(frames[tab], prefix + tables[tab])
        except Exception as problem:
            return f"{type(problem).__name__}: {problem}"
        return "ok"

    with ThreadPoolExecutor(at_once) as pool:
        # Each call gets a copy of this thread's job properties.
        begun = {tab: pool.submit(inheritable_thread_target(spark)(store), tab) for tab in frames}
        return {tab: work.result() for tab, work in begun.items()}
