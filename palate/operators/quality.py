"""Row counts and shape checks of produced tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for every table, as one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def table_problems(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Why a table is unusable: required columns it lacks, or that it is empty. Sound tables are left out."""
    problems = {}
    for name, df in tables.items():
        lacking = [c for c in required.get(name, ()) if c not in df.columns]
        if lacking:
            problems[name] = f"missing columns {', '.join(lacking)}"
        elif df.isEmpty():
            problems[name] = "empty"
    return problems
