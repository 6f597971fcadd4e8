import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palate.llm.va_clustering import Cells, Settings, centroids_of, cluster, nearest, oracle_sql, singled_out

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, s=Settings()):
    """The contract in Python integers."""
    kept = [
        (vec_id, tuple(int(np.floor(s.scale * x)) for x in own))
        for vec_id, own in rows
        if own is not None and len(own) == s.dims and all(x is not None and np.isfinite(x) for x in own)
    ]
    seeds = sorted((hashlib.sha256(f"{s.salt}{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [list(v) for _, v in seeds[: s.k]]
    if not centroids:
        return []

    def assign():
        found = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(s.rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, found) if c == k]
            if own:
                centroids[k] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    totals = [sum(d for c, d in found if c == k) for k in range(len(centroids))]
    return [(i, c, d, totals[c], sum(totals), names[c]) for (i, _), (c, d) in zip(kept, found)]


def check(spark, rows, settings):
    found = cluster(spark.createDataFrame(rows, SCHEMA), settings)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute(rows, settings), key=str)


def points(draw, n, dims, spread):
    middles = draw.normal(size=(5, dims))
    return [(i, (middles[draw.integers(5)] + spread * draw.normal(size=dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("seed", "dims", "bits", "spread"), [(0, 4, 2, 0.1), (1, 4, 6, 0.6), (2, 7, 4, 1.0)])
def test_against_brute_force(spark, seed, dims, bits, spread):
    check(spark, points(np.random.default_rng(seed), 300, dims, spread), Settings(dims=dims, bits=bits))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, -1.5]), (1, None), (2, []), (3, [1.0]), (4, [1.0, 2.0, 3.0]), (5, [nan, 1.0]),
        (6, [1.0, -inf]), (7, [None, 1.0]), (None, [5.0, 5.0]), (None, [1.0, 2.0]), (9, [0.0, 0.0]), (10, [-0.0, 0.0]),
        (11, [1e-9, -1e-9]), (12, [7.0, 7.0]), (13, [7.0, 7.0]), (14, [7.0, 7.5]), (15, [-3.0, 0.0]), (16, [-3.0, 2.0]),
    ]
    check(spark, rows, Settings(dims=2))
    check(spark, rows[:4], Settings(dims=2, k=8))
    check(spark, rows * 3, Settings(dims=2, k=2, rounds=3))
    extra = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("mine")).withColumn("part", F.lit(1))
    assert cluster(extra, Settings(dims=2)).count() == len(brute(rows, Settings(dims=2)))
    assert cluster(extra.limit(0)).collect() == [] == cluster(extra).collect()
    assert cluster(extra.where("vec_id is null"), Settings(dims=2)).collect() == []


def test_large_components_are_exact(spark):
    rows = [(i, [3e5 * (i % 3) + i, -1e5 * i]) for i in range(24)]
    check(spark, rows, Settings(dims=2, k=6))
    with pytest.raises(Exception, match="reaches 2"):
        cluster(spark.createDataFrame([(0, [1.0, 1e13]), (1, [0.0, 0.0])], SCHEMA), Settings(dims=2)).collect()


def test_intervals_never_lie():
    draw = np.random.default_rng(5)
    numbers = np.floor(draw.normal(size=(2000, 6)) * 1000)
    bounds = [np.unique(np.floor(np.quantile(c, np.linspace(0, 1, 17)[1:-1]))) for c in numbers.T]
    cells = Cells(bounds, [(c.min(), c.max()) for c in numbers.T])
    middle, half = cells.tables()
    own = cells.of(numbers)
    assert (np.abs(numbers - middle[np.arange(6), own]) <= half[np.arange(6), own]).all()
    for spread in (1, 300, 3000):
        centroids = np.floor(draw.normal(size=(5, 6)) * spread).astype(int).tolist()
        found, truth = singled_out(own, (middle, half), centroids), nearest(numbers, centroids)[0]
        assert (found[found >= 0] == truth[found >= 0]).all()
    assert (found >= 0).mean() > 0.5
    assert (singled_out(own, (middle, half), [centroids[0]] * 2) == -1).all()  # ties are left to exact distances


def test_rounds_read_full_vectors_of_some_parts_only(spark, monkeypatch):
    from palate.llm import va_clustering

    rows = points(np.random.default_rng(8), 600, 4, 0.05)
    seen = []
    parts_left = va_clustering._parts_left
    monkeypatch.setattr(va_clustering, "_parts_left", lambda placed, *a: seen.append((placed, parts_left(placed, *a))) or seen[-1][1])
    centroids_of(spark.createDataFrame(rows, SCHEMA), Settings(dims=4))
    placed = seen[0][0]
    everything = placed.select("part").distinct().count()
    assert len(seen) > 1 and all(len(parts) < everything for _, parts in seen[1:])
    plan = placed.select("cells", "part")._jdf.queryExecution().executedPlan().toString()
    assert "vector" not in plan.split("ReadSchema")[1]


def test_sql_on_odd_rows(spark):
    draw = np.random.default_rng(6)
    rows = [(int(draw.integers(0, 30)), draw.normal(size=3).tolist()) for _ in range(60)] + [(99, [1.0]), (98, None), (None, [0.0, 0.0, 1.0])]
    settings = Settings(dims=3, k=4, rounds=3)
    duck = duckdb.connect()
    duck.register("embeddings", pa.table({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows]}))
    expected = duck.sql(oracle_sql(settings)).fetchall()
    assert sorted(expected, key=str) == sorted(brute(rows, settings), key=str)
    check(spark, rows, settings)
