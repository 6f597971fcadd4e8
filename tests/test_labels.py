import pytest
from pyspark.sql import functions as F

from palate.operators import labels
from tests.conftest import rows_of


@pytest.fixture
def ratings(frames):
    return frames.ratings(*[(u, 1, 3.0, u * 100) for u in range(1, 21)])


def test_boundaries_row(ratings):
    (row,) = labels.split_boundaries(ratings).collect()
    assert row.asDict() | {"computed_at": None} == {
        "computed_at": None,
        "train_boundary_ts": 1200,
        "holdout_boundary_ts": 1600,
        "ratings_clean_row_count": 20,
        "min_timestamp": 100,
        "max_timestamp": 2000,
    }
    assert row.computed_at is not None


def test_boundaries_of_nothing(frames):
    assert labels.split_boundaries(frames.ratings()).count() == 0


@pytest.mark.parametrize("lazy", [False, True])
def test_split_flags(ratings, frames, lazy):
    exploded = frames.exploded((1, "A"))
    if lazy:
        stored = labels.split_boundaries(ratings)
        bounds = [stored.select(c).scalar() for c in ("train_boundary_ts", "holdout_boundary_ts")]
    else:
        bounds = [1200, 1600]
    result = labels.training_labels(ratings, exploded, *bounds)
    assert result.columns == ["userId", "genre", "label", "split_flag"]
    flags = dict(rows_of(result, "userId", "split_flag"))
    assert [flags[u] for u in range(1, 21)] == ["train"] * 12 + ["val"] * 4 + ["test"] * 4
    assert labels.train_val_only(result).count() == 16


def test_label_is_the_mean_per_user_genre_and_flag(frames):
    ratings = frames.ratings((1, 1, 2.0, 10), (1, 2, 4.0, 20), (1, 3, 5.0, 99))
    exploded = frames.exploded((1, "A"), (2, "A"), (3, "A"), (2, "B"))
    result = labels.training_labels(ratings, exploded, 50, 60)
    assert rows_of(result) == [(1, "A", 3.0, "train"), (1, "A", 5.0, "test"), (1, "B", 4.0, "train")]


def tables(spark):
    user_genre = spark.createDataFrame([(1, "A", 0.5), (2, "A", 0.7)], "userId BIGINT, genre STRING, genre_share DOUBLE")
    profiles = spark.createDataFrame([(1, 10), (3, 30)], "userId BIGINT, total_ratings BIGINT")
    return user_genre, profiles


def test_lookups_are_left_joins_and_need_a_profile(spark):
    user_genre, profiles = tables(spark)
    wanted = spark.createDataFrame([(1, "A", 4.0), (1, "B", 3.0), (2, "A", 2.0)], "userId BIGINT, genre STRING, label DOUBLE")
    found = labels.lookup_features(wanted, user_genre, profiles)
    assert rows_of(found, "userId", "genre", "genre_share", "total_ratings") == [
        (1, "A", 0.5, 10), (1, "B", None, 10), (2, "A", 0.7, None),
    ]
    assert rows_of(labels.training_set(wanted, user_genre, profiles), "userId", "genre") == [(1, "A"), (1, "B")]


def test_restriction_keeps_multiplicity(spark):
    wanted = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A")], "userId BIGINT, genre STRING")
    profiles = tables(spark)[1].unionAll(tables(spark)[1])
    assert rows_of(labels.restrict_to_feature_users(wanted, profiles)) == [(1, "A"), (1, "B")]


def test_holdout_is_strictly_after_the_boundary(spark, frames):
    ratings = frames.ratings((1, 1, 2.0, 100), (1, 1, 3.0, 101), (3, 1, 5.0, 150), (4, 1, 1.0, 160), (5, 9, 1.0, 170))
    exploded = frames.exploded((1, "A"), (1, "B"))
    assert rows_of(labels.holdout_cells(ratings, exploded, 100)) == [
        (1, "A", 3.0), (1, "B", 3.0), (3, "A", 5.0), (3, "B", 5.0), (4, "A", 1.0), (4, "B", 1.0),
    ]
    (row,) = labels.holdout_metadata(ratings, exploded, tables(spark)[1], 100).collect()
    assert tuple(row) == (4, 2, 101, 160)


def test_fractions_of_a_second_belong_to_their_second(frames):
    ratings = frames.ratings((1, 1, 2.0, 100)).withColumn("timestamp", F.timestamp_millis(F.lit(100_900)))
    assert labels.holdout_cells(ratings, frames.exploded((1, "A")), 100).count() == 0
    assert rows_of(labels.training_labels(ratings, frames.exploded((1, "A")), 100, 200), "split_flag") == [("train",)]


def test_time_filter_reaches_parquet(spark, frames, ratings, tmp_path):
    ratings.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    plan = labels.holdout_ratings(stored, frames.exploded((1, "A")), 1600)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp," in plan
