"""Every query with an SQL twin gives the same rows in an independent engine."""

import duckdb
import pytest

from palate.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    found = QUERIES[name](spark, sf)
    columns = sorted(found.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    rows = expected.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(rows, key=str)


def test_every_operator_is_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
