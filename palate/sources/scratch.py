"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from palate.sources.files import delete, write_parquet

_local_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set on the context; a temporary one only on a single machine."""
    context = spark.sparkContext
    on_cluster = not context.master.startswith("local")
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if on_cluster and configured.startswith("file:"):
            warnings.warn(f"{configured} must be one folder that all executors share", stacklevel=2)
        return configured.rstrip("/")
    if on_cluster:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="palate-")
    return _local_dirs[context.applicationId]


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/palate/{spark.sparkContext.applicationId}"


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete everything this application has staged, once no frame that reads it is needed any more."""
    delete(spark, _application_dir(spark))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several later steps read, and return a scan of it.

    Unlike a cached frame it survives the loss of executors, keeps column pruning and filter pushdown,
    and gives the optimizer real sizes.
    """
    path = new_dir(df.sparkSession, label)
    if _scopes:
        _scopes[-1].append(path)
    return _write(df, path)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block at its end; results must have been stored elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`stage`, for work that is finished inside the block; the copy is deleted at its end."""
    path = new_dir(df.sparkSession, label)
    try:
        yield _write(df, path)
    finally:
        delete(df.sparkSession, path)


def _write(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
