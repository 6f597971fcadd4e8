"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import palate.llm
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.sources.scratch import stage as _stage

#: Characters of a word; everything else separates words.
WORD = r"[^\x20\x09-\x0D]+"

# Functions of this folder travel to executors with their code, so nothing needs to be installed there.
cloudpickle.register_pickle_by_value(palate.llm)

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its shuffle files go as soon as it is written."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return _stage(df, label)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


def plain_names(docs: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all other columns renamed, so that no name can clash, and what each column is called now."""
    names = {c: c if c in needed else f"extra_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[_quoted(c).alias(name) for c, name in names.items()]), names


def own_names(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """Undo :func:`plain_names`; columns that were added since are dropped."""
    return docs.select(*[F.col(name).alias(c) for c, name in names.items()])


def _quoted(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def map_batches(
    df: DataFrame,
    columns: Sequence[str],
    fn: Callable[[Iterator[dict]], Iterator[dict]],
    schema: pa.Schema,
    rows: int = 512,
    arrow: bool = False,
) -> DataFrame:
    """Run ``fn`` over an iterator of column dictionaries of at most ``rows`` rows each; it yields the same of ``schema``.

    Columns come as lists, or with ``arrow`` as Arrow arrays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[dict[str, list]]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    piece = batch.slice(at, rows)
                    own = {name: piece.column(i) for i, name in enumerate(columns)}
                    yield own if arrow else {name: column.to_pylist() for name, column in own.items()}

        for out in fn(parts()):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return df.select(*columns).mapInArrow(run, _ddl(schema))


def _ddl(schema: pa.Schema) -> str:
    from pyspark.sql.pandas.types import from_arrow_schema

    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in from_arrow_schema(schema))


def unit_hash(*columns: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the columns and the seed alone."""
    digest = F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))
    return F.shiftrightunsigned(digest, 11).cast("double") / F.lit(float(1 << 53))
