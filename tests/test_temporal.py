import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from palate.operators import temporal
from palate.operators.temporal import (
    BLOCK,
    asof_join,
    feature_history,
    interval_join,
    moving_means,
    sessions,
    training_set_asof,
)

DAY = 86400


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_against_brute_force(spark, strict):
    rng = random.Random(1)
    # Key 0 owns half of all rows; times span many blocks and tie often; some keys have no version.
    keys = [0] * 400 + [rng.randrange(1, 9) for _ in range(400)]
    grid = [rng.randrange(-3 * BLOCK, 9 * BLOCK) for _ in range(60)]
    events = [(i, k, rng.choice(grid)) for i, k in enumerate(keys)] + [(900, None, 5), (901, 0, None), (902, 77, 5)]
    versions = [(k, rng.choice(grid), rng.choice([None, 1.0, 2.0])) for k in keys if k != 5]
    versions += [(None, 5, 1.0), (0, None, 2.0)]
    found = asof_join(
        spark.createDataFrame(events, "id long, k long, t long"),
        spark.createDataFrame(versions, "k long, since long, value double"),
        ["k"], "t", "since", ["value", "since"], strict=strict,
    )

    def expected(event):
        i, k, t = event
        own = [(s, v) for kk, s, v in versions if None not in (k, t, kk, s) and kk == k and (s < t if strict else s <= t)]
        if not own:
            return (i, k, t, None, None)
        latest = max(s for s, _ in own)
        best = max((v for s, v in own if s == latest), key=lambda v: (v is not None, v or 0))
        return (i, k, t, best, latest)

    assert found.columns == ["id", "k", "t", "value", "since"]
    assert rows_of(found) == sorted(map(expected, events), key=repr)


def test_asof_windows_hold_one_block_of_one_key(spark):
    events = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") * (BLOCK // 50)).alias("t"))
    versions = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") * (BLOCK // 50) + 7).alias("since"), "id")
    found = asof_join(events, versions, ["k"], "t", "since", ["id"])
    assert found.where("id = t div (1048576 div 50) - 1").count() == 4999
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_of_empty_sides(spark):
    events = spark.createDataFrame([(1, 5)], "k long, t long")
    versions = spark.createDataFrame([(1, 3, "a")], "k long, since long, v string")
    assert rows_of(asof_join(events, versions.limit(0), ["k"], "t", "since", ["v"])) == [(1, 5, None)]
    assert rows_of(asof_join(events.limit(0), versions, ["k"], "t", "since", ["v"])) == []


def test_interval_join_against_brute_force(spark):
    rng = random.Random(2)
    points = [(i, rng.choice([0, 0, 0, 1, 2]), rng.randrange(-5000, 50_000)) for i in range(500)] + [(500, None, 1), (501, 1, None)]
    intervals = []
    for i in range(300):
        start = rng.randrange(-6000, 50_000)
        end = rng.choice([start + 1, start + rng.randrange(1, 50), start + rng.randrange(1, 30_000), start, start - 5, None])
        intervals.append((1000 + i, rng.choice([0, 0, 1, 3]), start, end))
    intervals += [(2000, None, 0, 9), (2001, 0, None, 9), (2002, 0, -(1 << 40), 1 << 41), (2003, 0, 16, 32), (2004, 0, 15, 47)]
    found = interval_join(
        spark.createDataFrame(points, "p long, k long, t long"),
        spark.createDataFrame(intervals, "i long, k long, a long, b long"), ["k"], "t", "a", "b",
    )
    expected = [
        (p, i)
        for p, k, t in points
        for i, kk, a, b in intervals
        if k is not None and k == kk and t is not None and a is not None and a <= t and (b is None or t < b)
    ]
    assert rows_of(found.select("p", "i")) == sorted(expected, key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_intervals_are_listed_in_two_blocks_at_most(spark):
    """However long intervals are, points meet few of those that do not hold them."""
    points = spark.range(2000).select(F.lit(1).alias("k"), (F.col("id") * 1000).alias("t"))
    intervals = spark.range(2000).select(
        F.lit(1).alias("k"), "id", (F.col("id") * 1000).alias("a"), (F.col("id") * 1000 + 1 + F.col("id") % 3).alias("b")
    )
    found = interval_join(points, intervals, ["k"], "t", "a", "b")
    assert found.count() == 2000 and found.where("id * 1000 = t").count() == 2000
    none = interval_join(points, intervals.limit(0), ["k"], "t", "a", "b")
    assert none.count() == 0 and interval_join(points.limit(0), intervals, ["k"], "t", "a", "b").count() == 0


def test_history_and_point_in_time_lookup(frames):
    ratings = frames.ratings((1, 10, 4.0, 100), (1, 11, 2.0, 200), (1, 10, 5.0, 3 * DAY + 5), (1, 12, 1.0, 9 * DAY), (2, 10, 3.0, 50))
    exploded = frames.exploded((10, "A"), (11, "A"), (12, "A"), (12, "B"))
    history = feature_history(ratings, exploded)
    assert rows_of(history.where("userId = 1 and genre = 'A'")) == [
        (1, "A", 2, 3.0, 200, DAY, 4 * DAY),
        (1, "A", 3, 11 / 3, 3 * DAY + 5, 4 * DAY, 10 * DAY),
        (1, "A", 4, 3.0, 9 * DAY, 10 * DAY, None),
    ]
    found = training_set_asof(ratings, exploded, 150)
    assert rows_of(found) == [
        (1, 10, "A", 5.0, 3 * DAY + 5, 2, 3.0, 200),
        (1, 11, "A", 2.0, 200, None, None, None),
        (1, 12, "A", 1.0, 9 * DAY, 3, 11 / 3, 3 * DAY + 5),
        (1, 12, "B", 1.0, 9 * DAY, None, None, None),
    ]
    # No feature is newer than its label.
    assert found.where("last_rated >= rated_at").count() == 0


def test_moving_means_against_brute_force(frames):
    rng = random.Random(3)
    times = {u: [rng.randrange(0, 90 * DAY) for _ in range(n)] for u, n in ((1, 300), (2, 5), (3, 1))}
    times[4] = [7, 7, 7, 5 * DAY, 5 * DAY + 40]
    rows = [(u, m, rng.randrange(1, 11) / 2, t) for u, own in times.items() for m, t in enumerate(own)]
    found = {(r.userId, r.day): tuple(r)[2:] for r in moving_means(frames.ratings(*rows), days=30).collect()}
    expected = {}
    for u, own in times.items():
        ordered = sorted(own)
        gaps = [(b, b - a) for a, b in zip(ordered, ordered[1:])]
        for day in {t // DAY for t in own}:
            window = [r for uu, _, r, t in rows if uu == u and day - 29 <= t // DAY <= day]
            waits = [g for t, g in gaps if t // DAY == day]
            expected[u, day] = (sum(t // DAY == day for t in own), max(waits, default=None), len(window), sum(window) / len(window))
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key][:3] == values[:3] and found[key][3] == pytest.approx(values[3]), key


def test_sessions_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(0, 6 * BLOCK)) for _ in range(3000)] + [(4, 5), (4, 5), (None, 3), (1, None)]
    rows += [(5, BLOCK * 2 + d) for d in (-30, -1, 0, 20, 100)]
    df = spark.createDataFrame(rows, "k long, t long")
    for gap in (0, 60, 3000, 40_000, 3 * BLOCK):
        expected = []
        for key in {k for k, t in rows if k is not None and t is not None}:
            own = sorted(t for k, t in rows if k == key and t is not None)
            starts = [own[0]] + [b for a, b in zip(own, own[1:]) if b - a > gap]
            for i, start in enumerate(starts):
                upto = bisect_left(own, starts[i + 1]) if i + 1 < len(starts) else len(own)
                first = bisect_left(own, start)
                expected.append((key, start, own[upto - 1], upto - first))
        assert rows_of(sessions(df, "k", "t", gap)) == sorted(expected, key=repr), gap
    assert sessions(df.limit(0), "k", "t", 5).count() == 0


def test_moving_means_deal_more_ratings_to_more_tasks(frames, spark, monkeypatch):
    rows = [(user, movie, 1.0, movie * 7200) for user in range(10) for movie in range(40)]
    expected = sorted(map(tuple, moving_means(frames.ratings(*rows)).collect()))
    monkeypatch.setattr(temporal, "ROWS_OF_A_TASK", 25)
    dealt = moving_means(frames.ratings(*rows))
    assert dealt.rdd.getNumPartitions() == 16
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == expected


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_by_key_gives_the_same_rows(spark, strict):
    rng = random.Random(6)
    grid = [rng.randrange(-3 * BLOCK, 9 * BLOCK) for _ in range(40)]
    events = [(i, rng.choice([0, 0, 1, 2, 3]), rng.choice("ab"), rng.choice(grid)) for i in range(300)]
    events += [(900, None, "a", 5), (901, 0, None, 5), (902, 0, "a", None), (903, 77, "a", 5), (903, 77, "a", 5)]
    versions = [(rng.choice([0, 1, 2]), rng.choice("ab"), rng.choice(grid), rng.choice([None, 1.0, 2.0])) for _ in range(200)]
    versions += [(None, "a", 5, 1.0), (0, None, 5, 1.0), (0, "a", None, 2.0)]
    sides = (
        spark.createDataFrame(events, "id long, k long, g string, t int"),
        spark.createDataFrame(versions, "k long, g string, since long, value double"),
    )
    given = (["k", "g"], "t", "since", ["value", "since"], strict)
    expected, found = asof_join(*sides, *given), asof_join(*sides, *given, tasks=3)
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert rows_of(found) == rows_of(expected)


def test_interval_join_by_key_gives_the_same_rows(spark):
    rng = random.Random(7)
    points = [(i, rng.choice([0, 1, 2]), rng.randrange(-500, 5000)) for i in range(300)] + [(500, None, 1), (501, 1, None), (501, 1, 3), (501, 1, 3)]
    intervals = [(i, rng.choice([0, 1, 3]), a := rng.randrange(-600, 5000), rng.choice([None, a, a + 1, a + 70, a + 3000])) for i in range(100)]
    intervals += [(200, None, 0, 9), (201, 0, None, 9), (202, 0, -(1 << 40), 1 << 41), (202, 0, -(1 << 40), 1 << 41)]
    sides = (spark.createDataFrame(points, "p long, k long, t long"), spark.createDataFrame(intervals, "i long, k long, a long, b long"))
    given = (["k"], "t", "a", "b")
    expected, found = interval_join(*sides, *given), interval_join(*sides, *given, tasks=3)
    assert found.columns == expected.columns and rows_of(found) == rows_of(expected)
    assert interval_join(sides[0], sides[1].limit(0), *given, tasks=3).count() == 0
    # Rows are moved by key alone, before a point is listed on every level.
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(k#") == plan.count("Exchange ") == 2


def test_lookups_move_ratings_of_a_user_and_genre_once(frames, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.randrange(6), movie, rng.randrange(1, 11) / 2, rng.randrange(0, 90 * DAY)) for movie in range(200)]
    exploded = frames.exploded(*[(movie, genre) for movie in range(200) for genre in ("AB" if movie % 3 else "A")])
    ratings = frames.ratings(*rows)
    found = training_set_asof(ratings, exploded, 30 * DAY)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(userId#") == 2
    # A user with more rows than a task should hold is left to the blocks.
    monkeypatch.setattr(temporal, "ROWS_OF_A_TASK", 20)
    assert temporal.tasks_by_key(ratings) is None
    assert rows_of(training_set_asof(ratings, exploded, 30 * DAY)) == rows_of(found)
    assert temporal.tasks_by_key(ratings.limit(0)) == 8
