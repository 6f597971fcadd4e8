"""Run the queries against their SQL on one data set and report mismatches and times.

    python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from palate.checks.oracles import ORACLES
from palate.checks.queries import QUERIES


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(row[i]) for i in order) for row in rows], key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str:
    """``ok`` or what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return f"rows only ({len(ours)})"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if ours == theirs:
        return f"ok ({len(ours)})"
    wrong = next(((a, b) for a, b in zip(ours, theirs) if a != b), None)
    return f"MISMATCH {len(ours)} vs {len(theirs)} rows, first {wrong}"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for query in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            outcome = compare(session, con, sf_dir, query)
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{query:28s} {time.time() - start:6.1f}s  {outcome}", flush=True)
