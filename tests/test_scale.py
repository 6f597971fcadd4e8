"""What the plans must look like for data that one task, or the driver, could not hold."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from palate.checks.queries import QUERIES
from palate.operators import features, labels, silver
from tests.conftest import rows_of

SMALLEST = "/root/testdata/sf0.001"


@contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Ratings of which one movie has a third and one user another third; tables too large to broadcast."""
    root = str(tmp_path_factory.mktemp("hot"))
    i = F.col("id")
    ratings = spark.range(0, 120_000, 1, 8).select(
        F.when(i % 3 == 1, 0).otherwise(i % 2000 + 1).alias("userId"),
        F.when(i % 3 == 0, 0).otherwise(i % 9000).alias("movieId"),
        ((i % 10 + 1) * 0.5).alias("rating"),
        F.timestamp_seconds(i * 1000).alias("timestamp"),
    )
    genres = F.explode(F.array(*[F.lit(g) for g in "ABC"])).alias("genre")
    movies = spark.range(0, 9000).select(i.alias("movieId"), F.lit("t").alias("title"), genres)
    scores = ratings.select("movieId", (F.col("userId") % 700).alias("tagId"), F.col("rating").alias("relevance"))
    for name, df in {"ratings": ratings, "movies": movies, "scores": scores}.items():
        df.write.parquet(f"{root}/{name}")
    ratings, movies, scores = (spark.read.parquet(f"{root}/{n}") for n in ("ratings", "movies", "scores"))
    genome = movies.select("movieId", "genre", F.lit(0.5).alias("avg_genome_relevance"))
    tags = ratings.select("userId", "movieId", (F.col("movieId") % 50).cast("string").alias("tag"), "timestamp")
    known = spark.range(0, 700).select(F.col("id").alias("tagId"), F.lit("x").alias("tag"))
    return {
        "user_genre": features.user_genre_features(ratings, movies, genome, tags),
        "profiles": features.user_profile_features(ratings, movies),
        "labels": labels.training_labels(ratings, movies, 30_000_000, 90_000_000),
        "genome": silver.aggregate_genome(scores, known, movies),
    }


@pytest.mark.parametrize("name", ["user_genre", "profiles", "labels", "genome"])
def test_hot_keys_are_split_and_results_stay_whole(spark, hot, name):
    def rounded(df):
        return rows_of(df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]))

    expected = rounded(hot[name])
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="48",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
    ):
        df = hot[name].select("*")
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        assert rounded(hot[name].select("*")) == expected


CHEAP = sorted(
    set(QUERIES)
    - {"fit_multi_output", "batch_score", "ingest_csv", "ingest_all", "ingest_missing", "links_text_keys"}
    - {"replay_store", "upsert_features", "built_user_genre", "built_boundaries", "drift_check"}
    - {"built_user_genre_full", "built_profiles", "mean_model_metrics", "mean_model_scores", "table_problems"}
)


@pytest.mark.parametrize("name", CHEAP)
def test_no_query_pairs_everything_with_everything(spark, name):
    with conf(spark, spark__sql__adaptive__enabled="false"):
        plan = QUERIES[name](spark, SMALLEST)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def nodes(plan):
    return [line.lstrip(" :+-*()0123456789").split("(")[0].split(" ")[0] for line in plan.splitlines()]


def test_ratings_are_summed_before_every_shuffle_of_them(spark, hot):
    """No exchange, sort or window ever sees raw ratings when the genres fit into memory."""
    plan = hot["user_genre"]._jdf.queryExecution().executedPlan().toString()
    below = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        while below and below[-1][0] >= depth:
            below.pop()
        below.append((depth, line))
        if "FileScan parquet" in line and "rating#" in line:
            path = [n for _, text in below for n in nodes(text)]
            first_exchange = max(i for i, n in enumerate(path) if n == "Exchange")
            assert "HashAggregate" in path[first_exchange + 1 :]
            assert not {"Sort", "Window"} & set(path[first_exchange + 1 :])


def test_duplicates_are_reduced_before_the_shuffle(spark, frames):
    plan = silver.clean_ratings(frames.raw_ratings((1, 1, 1.0, 1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(userId") < plan.index("partial_max")
    assert "Window" not in plan
