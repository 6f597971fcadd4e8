from pyspark.sql import functions as F

from palate.operators import silver
from tests.conftest import rows_of


def seconds(df):
    return df.withColumn("timestamp", F.unix_seconds("timestamp"))


def test_newest_rating_survives(frames):
    raw = frames.raw_ratings((1, 10, 3.0, 1000), (1, 10, 5.0, 2000), (1, 11, 2.0, 500), (2, 10, 4.0, 7))
    assert rows_of(seconds(silver.clean_ratings(raw))) == [(1, 10, 5.0, 2000), (1, 11, 2.0, 500), (2, 10, 4.0, 7)]


def test_tie_on_time_is_decided_by_rating(frames):
    raw = frames.raw_ratings((1, 10, 3.0, 1000), (1, 10, 4.0, 1000), (1, 10, 3.5, 1000))
    assert rows_of(silver.clean_ratings(raw), "rating") == [(4.0,)]


def test_incomplete_rows_are_dropped_and_types_kept(frames):
    raw = frames.raw_ratings(
        (None, 1, 1.0, 1), (1, None, 1.0, 1), (1, 1, None, 1), (1, 1, 1.0, None), (1, 2, float("nan"), 1), (3, 3, 3.0, 3)
    )
    clean = silver.clean_ratings(raw)
    assert rows_of(clean, "userId") == [(3,)]
    assert clean.dtypes == [("userId", "bigint"), ("movieId", "bigint"), ("rating", "double"), ("timestamp", "timestamp")]


def test_null_filters_reach_the_scan(spark, frames, tmp_path):
    frames.raw_ratings((1, 1, 1.0, 1)).write.parquet(str(tmp_path / "r"))
    plan = silver.clean_ratings(spark.read.parquet(str(tmp_path / "r")))._jdf.queryExecution().executedPlan().toString()
    for column in ("userId", "movieId", "rating", "timestamp"):
        assert f"IsNotNull({column})" in plan


def test_explode_splits_and_drops_unlisted(frames):
    movies = frames.movies(
        (1, "a", "Action|Crime|Thriller"), (2, "b", "(no genres listed)"), (3, "c", None), (4, "d", ""), (5, "e", "Sci-Fi")
    )
    assert rows_of(silver.explode_genres(movies), "movieId", "genre") == [
        (1, "Action"), (1, "Crime"), (1, "Thriller"), (4, ""), (5, "Sci-Fi"),
    ]


def test_variant_leaves_out_excluded_genres(frames):
    exploded = frames.exploded((1, "Action"), (1, "Children"), (2, "Fantasy"), (3, "Drama"))
    assert rows_of(silver.filter_variant(exploded, ["Children", "Animation", "Fantasy"]), "genre") == [("Action",), ("Drama",)]


def test_genome_is_averaged_per_movie_and_genre(spark, frames):
    scores = spark.createDataFrame(
        [(1, 1, 0.2), (1, 2, 0.6), (2, 1, 0.9), (2, 9, 0.1), (3, 1, 0.5), (4, 1, None)],
        "movieId BIGINT, tagId BIGINT, relevance DOUBLE",
    )
    tags = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "tagId BIGINT, tag STRING")
    exploded = frames.exploded((1, "A"), (1, "B"), (2, "A"), (4, "A"), (5, "A"))
    result = silver.aggregate_genome(scores, tags, exploded)
    assert result.columns == ["movieId", "genre", "avg_genome_relevance"]
    assert rows_of(result) == [(1, "A", 0.4), (1, "B", 0.4), (2, "A", 0.9), (4, "A", None)]


def test_genome_counts_a_repeated_tag_like_a_join(spark, frames):
    scores = spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.9)], "movieId BIGINT, tagId BIGINT, relevance DOUBLE")
    tags = spark.createDataFrame([(1, "x"), (1, "x2"), (2, "y")], "tagId BIGINT, tag STRING")
    (row,) = silver.aggregate_genome(scores, tags, frames.exploded((1, "A"), (1, "A"))).collect()
    assert abs(row.avg_genome_relevance - 0.3) < 1e-12


def test_holdout_split_at_the_quantile(frames):
    ratings = frames.ratings(*[(u, 1, 3.0, u) for u in range(1, 11)])
    training, holdout = silver.split_holdout(ratings)
    assert [r[0] for r in rows_of(training, "userId")] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert rows_of(holdout, "userId") == [(10,), (9,)]


def test_holdout_split_is_disjoint_and_complete(frames):
    ratings = frames.ratings(*[(1, m, 3.0, 10 * (m // 3)) for m in range(50)])
    training, holdout = (rows_of(df) for df in silver.split_holdout(ratings))
    assert not set(training) & set(holdout)
    assert sorted(training + holdout, key=repr) == rows_of(ratings)


def test_holdout_split_of_nothing(frames):
    assert [df.count() for df in silver.split_holdout(frames.ratings())] == [0, 0]
