"""Ratings that arrive as files, taken up by Structured Streaming.

Every micro-batch is stored as a slice under its batch id, so a batch that runs again after a crash replaces what it
wrote. Which files a batch holds is in the query's checkpoint; a restarted query goes on where the last one stopped.
Late rows are rows like any other: nothing is dropped for its age, and the newest rating of a user and movie is found
when the slices are read, whatever order they came in. How late rows were is counted per batch against a watermark, the
newest time seen before the batch less ``patience``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate import settings
from palate.operators.silver import clean_ratings
from palate.sources.tables import TableStore

SCHEMA = "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT"
_PROGRESS = "batch BIGINT, rows BIGINT, late BIGINT, newest BIGINT"


def take_up(store: TableStore, landing: str, checkpoint: str, files_per_batch: int = 100, patience: int = 86400) -> None:
    """Store every file below ``landing`` that has not been taken up, in batches of so many files, and return."""
    spark = store.spark

    def store_batch(rows: DataFrame, batch: int) -> None:
        _add(store, settings.RATINGS_ARRIVED, rows, batch)
        before = _read(store, settings.ARRIVAL_PROGRESS, _PROGRESS).where(F.col("batch") < batch)
        newest = before.agg(F.max("newest")).first()[0]
        watermark = F.lit(None if newest is None else newest - patience).cast("long")
        late = F.count_if(F.col("timestamp") < watermark)
        held = store.read_slice(settings.RATINGS_ARRIVED, batch) if batch in store.slices(settings.RATINGS_ARRIVED) else rows
        own = held.agg(
            F.lit(batch).cast("long").alias("batch"),
            F.count(F.lit(1)).alias("rows"),
            late.alias("late"),
            F.max("timestamp").alias("newest"),
        )
        _add(store, settings.ARRIVAL_PROGRESS, own, batch)

    arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    query = (
        arriving.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _add(store: TableStore, name: str, rows: DataFrame, batch: int) -> None:
    """Store a batch under its id; the first one that has rows makes the table."""
    if store.slices(name):
        store.write_slice(name, rows, batch)
    else:
        store.overwrite_sliced(name, rows, batch)


def _read(store: TableStore, name: str, schema: str) -> DataFrame:
    return store.read(name) if store.slices(name) else store.spark.createDataFrame([], schema)


def settled(store: TableStore) -> DataFrame:
    """The clean ratings of everything taken up so far."""
    return clean_ratings(_read(store, settings.RATINGS_ARRIVED, SCHEMA))
