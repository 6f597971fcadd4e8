"""Access to whatever file system a path is on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_TIMES = "spark.sql.parquet.outputTimestampType"


def locate(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = locate(spark, path)
    return fs.exists(at)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, at = locate(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(at)] if fs.exists(at) else []


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", by: Sequence[str] = ()) -> None:
    """Write a folder whose time columns carry statistics, whatever the session's default is.

    The default 96-bit times have none, so a filter on time could not skip a single row group.
    """
    conf = df.sparkSession.conf
    before = conf.get(_TIMES, None)
    conf.set(_TIMES, "TIMESTAMP_MICROS")
    try:
        df.write.mode(mode).partitionBy(*by).parquet(path)
    finally:
        if before is None:
            conf.unset(_TIMES)
        else:
            conf.set(_TIMES, before)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = locate(spark, path)
    fs.delete(at, True)
