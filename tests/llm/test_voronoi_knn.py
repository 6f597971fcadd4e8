import random

import pytest
from pyspark.sql import functions as F

from palate.llm.voronoi_knn import Settings, search

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, score STRING"


def brute_force(rows, settings):
    import math

    whole = {
        i: [math.floor(settings.scale * x) for x in v]
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, own in whole.items():
        if q % settings.every == 0:
            scored = [
                (-sum(a * b for a, b in zip(own, v, strict=True)), i)
                for i, v in whole.items()
                if i != q and len(v) == len(own)
            ]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[: settings.k], 1)]
    return sorted(out)


@pytest.mark.parametrize("settings", [Settings(k=5, every=3), Settings(k=3, every=2, pivots=7, block=6, query_block=4)])
def test_same_as_brute_force(spark, settings):
    draw = random.Random(2)
    rows = [(i, [float(x) / 64 for x in draw.choices(range(-9, 10), k=4)], 1, "x") for i in range(150)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.25], 1, None) for i in range(30)]  # ties
    rows += [(300, None, 1, ""), (301, [1.0, None, 0.0, 0.0], 1, ""), (302, [float("nan")] * 4, 1, "")]
    rows += [(303, [float("inf")] * 4, 1, ""), (304, [0.0] * 4, 1, ""), (306, [0.25, 0.5], 1, ""), (308, [0.5, 0.5], 1, "")]
    found = search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % settings.every == 0, settings)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, settings)


def brute_force_of_rows(rows, settings):
    """Every row counts, as in the query's SQL: repeated ones, and several vectors of one id."""
    import math

    whole = [(i, [math.floor(settings.scale * x) for x in v]) for i, v, *_ in rows]
    out = []
    for q in sorted({i for i, _ in whole if i % settings.every == 0}):
        scored = sorted(
            (-sum(a * b for a, b in zip(own, v, strict=True)), j)
            for i, own in whole
            for j, v in whole
            if i == q and j != q and len(own) == len(v)
        )
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[: settings.k], 1)]
    return sorted(out)


def test_every_row_is_a_candidate(spark):
    rows = [(i, [i / 8, 1.0], 1, "") for i in range(12)] + [(11, [11 / 8, 1.0], 1, "again")] * 2 + [(6, [0.75, 1.0], 1, "")]
    settings = Settings(k=4, every=3)
    found = search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 3 == 0, settings)
    assert sorted(map(tuple, found.collect())) == brute_force_of_rows(rows, settings)


def test_several_vectors_of_one_id_never_find_each_other(spark):
    draw = random.Random(8)
    rows = [(0, [50.0 + draw.random(), 50.0], 1, "") for _ in range(30)]
    rows += [(i, [draw.uniform(-9, 9), draw.uniform(-9, 9)], 1, "") for i in range(1, 60)]
    settings = Settings(k=5, every=20, block=4, query_block=4, pivots=9)
    found = search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, settings)
    assert sorted(map(tuple, found.collect())) == brute_force_of_rows(rows, settings)


def test_large_components_are_exact(spark):
    rows = [(0, [1.0], 1, ""), (1, [3e6], 1, ""), (2, [2e6], 1, ""), (3, [5.0], 1, ""), (3, [5.0], 1, "")]
    found = search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, Settings())
    assert sorted(map(tuple, found.collect())) == [
        (0, 1, 1, 12_288_000_000), (0, 2, 2, 8_192_000_000), (0, 3, 3, 64 * 320), (0, 4, 3, 64 * 320),
    ]
    large = [(i, [float(1 << 34) * (-1) ** i, float(i)], 1, "") for i in range(50)]
    found = search(spark.createDataFrame(large, "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, score STRING"), F.lit(False), Settings())
    assert found.count() == 0
    with pytest.raises(Exception, match="2\\*\\*62"):
        search(spark.createDataFrame([(0, [1e30], 1, ""), (1, [1.0], 1, "")], SCHEMA), F.lit(True)).collect()


def test_bounds_leave_out_far_cells(spark):
    from palate.llm import voronoi_knn as v

    rows = [(i, [50.0 + i % 5, 0.0], 1, "") for i in range(40)] + [(100 + i, [-50.0 - i % 5, 0.0], 1, "") for i in range(40)]
    settings = Settings(k=3, pivots=20, block=100, query_block=100)
    numbers = v.whole_numbers(spark.createDataFrame(rows, SCHEMA), settings)
    pivots = v._pivots(numbers, settings)
    cells = v._cells(numbers, pivots)
    data, queries = v._cut(cells, 100, "d"), v._cut(cells, 100, "q")
    wanted = v._needed(queries, data, pivots, settings).count()
    assert 0 < wanted <= queries.count() * data.count() / 2


def test_few_vectors_and_empty_table(spark):
    one = spark.createDataFrame([(0, [1.0], 1, "")], SCHEMA)
    assert search(one, F.lit(True)).count() == 0
    assert search(one.limit(0), F.lit(True)).count() == 0
