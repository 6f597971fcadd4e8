"""CSV landing files to bronze tables, read by executors and never through the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from palate import schemas
from palate.settings import BRONZE_FILES
from palate.sources.tables import TableStore


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header that must name the columns of ``schema`` in order; quotes double inside quotes.

    A value that does not fit its column stops the job: as a null it would be lost without a trace.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def ingest_csv(store: TableStore, path: str, table: str, schema: str) -> DataFrame:
    """Load one file into a table unchanged, replacing what was there."""
    return store.overwrite(table, read_csv(store.spark, path, schema))


def ingest_all(
    store: TableStore, landing: str, files: Mapping[str, str] = BRONZE_FILES
) -> dict[str, DataFrame]:
    """Load every landing file; returns the bronze tables by bare name."""
    return {
        table: ingest_csv(store, f"{landing}/{filename}", f"bronze.{table}", schemas.BRONZE[table])
        for table, filename in files.items()
    }


def ingest_missing(
    store: TableStore, landing: str, files: Mapping[str, str] = BRONZE_FILES
) -> dict[str, str]:
    """Load only the tables that do not exist yet; returns ``loaded`` or ``skipped`` per table."""
    missing = {t: f for t, f in files.items() if not store.exists(f"bronze.{t}")}
    ingest_all(store, landing, missing)
    return {table: "loaded" if table in missing else "skipped" for table in files}
