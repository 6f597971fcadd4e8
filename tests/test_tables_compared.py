import random

import pytest
from pyspark.sql import functions as F

from palate.operators.diff import table_diff
from palate.operators.ranking import best_of_group, global_ranks, leaders
from tests.conftest import rows_of


def test_diff_of_rows_and_bags(spark):
    schema = "k long, a string, b double"
    nan = float("nan")
    before = [
        (1, "x", 1.0), (2, "x", None), (3, None, 1.0), (4, "gone", 1.0), (5, "twice", 1.0), (5, "twice", 1.0),
        (6, "p", 1.0), (6, "q", 2.0), (7, None, None), (None, "n", 1.0), (8, "v", nan), (9, None, 2.0),
    ]
    after = [
        (1, "x", 1.0), (2, "y", 0.0), (3, None, 1.0), (5, "twice", 1.0), (6, "q", 1.0), (6, "p", 2.0), (7, None, None),
        (None, "m", 1.0), (8, "v", nan), (10, "new", 1.0), (9, None, None),
    ]
    found = table_diff(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema).select("b", "k", "a"), ["k"])
    assert found.columns == ["k", "change", "changed_columns", "rows_before", "rows_after"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([
        (2, "changed", ["a", "b"], 1, 1), (4, "removed", None, 1, 0), (5, "changed", None, 2, 1),
        (6, "changed", None, 2, 2), (None, "changed", ["a"], 1, 1), (10, "added", None, 0, 1), (9, "changed", ["b"], 1, 1),
    ], key=repr)
    same = spark.createDataFrame(before, schema)
    assert table_diff(same, same.orderBy(F.rand(1)), ["k"]).count() == 0
    assert table_diff(same.limit(0), same, ["k"]).where("change <> 'added'").count() == 0
    with pytest.raises(ValueError):
        table_diff(same, same.drop("a"), ["k"])


def test_a_null_is_not_its_neighbour(spark):
    """Swapping a null and a value between columns is a change."""
    before = spark.createDataFrame([(1, "v", None)], "k long, a string, b string")
    after = spark.createDataFrame([(1, None, "v")], "k long, a string, b string")
    assert rows_of(table_diff(before, after, ["k"]), "k", "change", "changed_columns") == [(1, "changed", ["a", "b"])]


def test_ranks_against_brute_force(spark):
    rng = random.Random(5)
    # Half of all rows share one score.
    rows = [(i, i % 7, 2.5 if i % 2 else rng.choice([None, rng.randrange(40) / 4])) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g long, s double")
    scores = [s for _, _, s in rows]

    def order(s):
        return (s is None, -(s or 0))

    def rank(s, among):
        return 1 + sum(order(t) < order(s) for t in among)

    def dense(s):
        return 1 + len({t for t in scores if order(t) < order(s)})

    found = {r.id: (r["rank"], r.dense_rank) for r in global_ranks(df, "s").collect()}
    assert found == {i: (rank(s, scores), dense(s)) for i, _, s in rows}
    assert {r.id for r in leaders(df, "s", 50).collect()} == {i for i, _, s in rows if rank(s, scores) <= 50}
    of_group = {g: [s for _, h, s in rows if h == g] for g in range(7)}
    best = {r.id: r.group_rank for r in best_of_group(df, "g", "s", 5).collect()}
    assert best == {i: rank(s, of_group[g]) for i, g, s in rows if rank(s, of_group[g]) <= 5}
    assert global_ranks(df.limit(0), "s").count() == 0 and best_of_group(df.limit(0), "g", "s", 5).count() == 0


def test_no_window_runs_over_everything(spark):
    df = spark.range(1000).select(F.col("id").alias("s"), (F.col("id") % 3).alias("g"))
    for found in (global_ranks(df, "s"), best_of_group(df, "g", "s", 2)):
        assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
