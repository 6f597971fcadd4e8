"""Ratings that list their genres, and the steps that read them, move rows no more often than they must."""

import re

import pytest
from pyspark.sql import functions as F

from palate.checks import testbed
from palate.checks.queries import QUERIES
from palate.checks.testbed import Testbed
from palate.operators import boosting, features, labels, matrix, silver, temporal
from palate.settings import GENRE_FEATURES, PROFILE_FEATURES, BoostingParams
from palate.sources.scratch import stage
from tests.conftest import rows_of
from tests.test_scale import conf


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture
def parts(frames):
    ratings = frames.ratings((1, 1, 4.0, 100), (1, 2, 2.0, 90_000), (1, 9, 5.0, 200_000), (2, 1, 1.0, 300), (3, 9, 3.0, 5))
    exploded = frames.exploded((1, "A"), (1, "B"), (2, "A"), (2, "A"))
    genome = frames.genome((1, "A", 0.25), (1, "B", 0.75))
    return ratings, exploded, genome


def test_listed_ratings_give_what_a_join_gives(parts):
    ratings, exploded, genome = parts
    listed, described = silver.list_genres(ratings, exploded), silver.list_genres(ratings, exploded, genome)
    assert rows_of(listed.drop("genres")) == rows_of(ratings)
    pairs = [
        (features.genre_sums(described), features.genre_sums(ratings, exploded, genome)),
        (features.user_profile_features(described), features.user_profile_features(ratings, exploded)),
        (labels.training_labels(listed, None, 200, 100_000), labels.training_labels(ratings, exploded, 200, 100_000)),
        (labels.holdout_cells(listed, None, 200), labels.holdout_cells(ratings, exploded, 200)),
        (temporal.feature_history(listed), temporal.feature_history(ratings, exploded)),
        (silver.per_genre(silver.keep_listed(listed, ["A"]), None).select("movieId", "genre"),
         silver.per_genre(ratings, silver.filter_variant(exploded, ["A"])).select("movieId", "genre")),
    ]
    for ours, theirs in pairs:
        assert rows_of(ours) == rows_of(theirs, *ours.columns)


def test_listed_ratings_are_not_moved_to_their_movie_again(spark, parts):
    ratings, exploded, genome = parts
    described = stage(silver.list_genres(ratings, exploded, genome), "described")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert exchanges(features.genre_sums(described)) == 1
        assert exchanges(labels.training_labels(described, None, 200, 100_000)) == 1


def test_a_lookup_moves_features_by_user_only(spark):
    kind = "userId BIGINT, genre STRING, genre_share DOUBLE"
    user_genre = stage(spark.createDataFrame([(1, "A", 0.5), (1, "C", 0.1), (2, "A", 0.7)], kind), "features")
    profiles = stage(spark.createDataFrame([(1, 10), (3, 30)], "userId BIGINT, total_ratings BIGINT"), "profiles")
    wanted = [(1, "A", 4.0), (1, "B", 3.0), (3, "A", 2.0), (None, "A", 1.0), (1, None, 5.0)]
    wanted = stage(spark.createDataFrame(wanted, "userId BIGINT, genre STRING, label DOUBLE"), "wanted")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = labels.lookup_features(wanted, user_genre, profiles)
        assert exchanges(found) == 3
    assert rows_of(found, "userId", "genre", "label", "total_ratings", "genre_share") == sorted([
        (1, "A", 4.0, 10, 0.5), (1, "B", 3.0, 10, None), (3, "A", 2.0, 30, None),
        (None, "A", 1.0, None, None), (1, None, 5.0, 10, None),
    ], key=repr)


def training_cells(spark):
    one = F.col("id").cast("double")
    return spark.range(0, 60).select(
        (F.col("id") % 20).alias("userId"), F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("genre"),
        F.when(F.col("id") % 20 < 12, "train").otherwise("val").alias("split_flag"), one.alias("label"),
        *[F.lit(1.5).alias(n) for n in PROFILE_FEATURES], *[(one * 2).alias(n) for n in GENRE_FEATURES],
    )


def test_features_and_labels_pivot_in_one_pass(spark):
    cells = stage(training_cells(spark), "cells")
    both = matrix.pivot_training(cells, "BA", by=["split_flag"])
    for flag in ("train", "val"):
        own, mine = both.where(F.col("split_flag") == flag), cells.where(F.col("split_flag") == flag)
        wide, truth = matrix.pivot_features(mine, "BA"), matrix.pivot_labels(mine, "BA")
        assert rows_of(own, *wide.columns) == rows_of(wide)
        assert rows_of(own, "userId", "target_A", "target_B") == rows_of(truth)
    by_user = matrix.pivot_training(cells.repartition(4, "userId"), "BA", by=["split_flag"])
    assert "ENSURE_REQUIREMENTS" not in by_user._jdf.queryExecution().executedPlan().toString()


def test_a_model_of_single_leaves_writes_no_rows(spark, monkeypatch):
    def unwanted(*_):
        raise AssertionError("rows were written")

    monkeypatch.setattr(boosting, "staged", unwanted)
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "x DOUBLE, y DOUBLE")
    fitted = boosting.fit(rows, ["x"], ["y"], BoostingParams(trees=1, learning_rate=0.1, leaves=1))
    assert fitted.base == [3 * boosting.UNIT] and fitted.trees == []


def test_points_are_listed_on_few_levels(spark):
    """Lengths from a day to four years lie on three levels, so a point is listed at most three times."""
    lengths = [86_400 * 2**n for n in range(11)]
    intervals = spark.createDataFrame([(1, 0, n) for n in lengths], "key INT, start LONG, end LONG")
    points = spark.createDataFrame([(1, 5), (1, 100_000)], "key INT, at LONG")
    found = temporal.interval_join(points, intervals, ["key"], "at", "start", "end")
    assert found.count() == 21
    levels = {a or b for a, b in re.findall(r"__level, (\d+)|(\d+) AS __level", found._jdf.queryExecution().analyzed().toString())}
    assert levels == {"20", "24", "28"}


def test_a_pivot_groups_cells_once_and_averages_repeated_ones(spark):
    once = training_cells(spark)
    again = once.where("userId % 2 = 0").withColumn("label", F.col("label") + 3)
    gaps = once.where("userId = 4").withColumn("genre_share", F.lit(None).cast("double")).withColumn("genre", F.lit("C"))
    cells = stage(once.unionAll(again).unionAll(gaps), "repeated")
    ours = matrix.pivot_training(cells, "ABC", by=["split_flag"])
    assert "pivotfirst" not in ours._jdf.queryExecution().executedPlan().toString()
    keys, values = ["userId", "split_flag", *PROFILE_FEATURES], [*GENRE_FEATURES, "label"]
    plain = cells.groupBy(*keys).pivot("genre", ["A", "B", "C"]).agg(*[F.avg(v).alias(v) for v in values])
    expected = plain.na.fill(0.0).select(
        "userId", "split_flag", *PROFILE_FEATURES, *[f"{g}_{v}" for v in values for g in "ABC"]
    )
    assert list(map(str, rows_of(ours))) == list(map(str, rows_of(expected)))
    unlisted = matrix.pivot_training(cells, "D")
    assert unlisted.count() == 20 and not unlisted.where("target_D != 0").count()


def test_profiles_read_ratings_that_were_joined_once(spark):
    plan = QUERIES["user_profile_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join", plan.split("== Initial Plan ==")[0])) == 1


def test_larger_tables_meet_in_more_tasks(spark, monkeypatch):
    few = Testbed(spark, "/root/testdata/sf0.001").ratings
    monkeypatch.setattr(testbed, "ROWS_OF_A_TASK", 400)
    more = Testbed(spark, "/root/testdata/sf0.001").ratings
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = more.select("*")._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\([lo]_orderkey#\d+L, (\d+)\)", plan)
    assert len(dealt) == 2 and all(int(tasks) >= 15 for tasks in dealt)
    assert rows_of(more) == rows_of(few)


def test_ratings_are_worked_out_before_items_are_shuffled(spark):
    ratings = Testbed(spark, "/root/testdata/sf0.001").ratings
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = ratings.select("*")._jdf.queryExecution().executedPlan().toString()
    after_exchange = plan.split("Exchange")[0]
    assert "l_quantity" not in after_exchange and "l_discount" not in after_exchange
