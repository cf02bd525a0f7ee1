"""Given tables, read by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyshelf import session

RUN_TS = "2024-05-01 06:30:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.apply_settings(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _parts_at_least(rows: DataFrame, wanted: int) -> bool:
    """Whether the files of a plain scan have ``wanted`` row groups, the smallest parts a file is read in; footers tell."""
    jvm, conf = rows.sparkSession._jvm, rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
    found = 0
    for file in rows.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            found += reader.getRowGroups().size()
        finally:
            reader.close()
        if found >= wanted:
            return True
    return False


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same rows dealt to all cores, for work that is far larger than the file they are read from.

    A table that all cores read anyway, two row groups each at least, is not moved.
    """
    rows, cores = table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    if rows._jdf.queryExecution().toRdd().getNumPartitions() >= cores and _parts_at_least(rows, 2 * cores):
        return rows
    return rows.repartition(cores)
