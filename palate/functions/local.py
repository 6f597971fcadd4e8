"""Rows the driver already holds, as a local relation: no job to distribute them, and a known tiny size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TEXT, NUMBER, COUNT = pa.string(), pa.float64(), pa.int64()
NUMBERS = pa.list_(NUMBER)


def local_frame(spark: SparkSession, columns: Mapping[str, pa.DataType], rows: Sequence[Sequence]) -> DataFrame:
    schema = pa.schema(list(columns.items()))
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(columns, row)) for row in rows], schema=schema))
