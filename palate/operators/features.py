"""Silver to gold: per-(user, genre) and per-user features.

Ratings are shuffled once, already summed per task, and never grouped raw by user or movie: a user or movie
that owns much of the table costs one partial row per task. What is later gathered per user is that user's
sums, at most one row per genre. The join to the genres of a movie keys on the movie and is followed by an
aggregate on other keys, so adaptive execution may broadcast the genres when they are small and split a hot
movie when they are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.functions.expressions import Decay, epoch, in_sample
from palate.operators.silver import per_genre, with_relevance
from palate.settings import DECAY_PER_DAY, SAMPLE_SEED, SECONDS_PER_DAY


def sample_users(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED, key: str = "userId") -> DataFrame:
    """All rows of a fixed pseudo-random fraction of the users; the same users in every table."""
    return df if fraction >= 1.0 else df.where(in_sample(key, fraction, seed))


def genre_sums(
    ratings: DataFrame,
    exploded: DataFrame | None = None,
    genome: DataFrame | None = None,
    decay_per_day: float = DECAY_PER_DAY,
) -> DataFrame:
    """Sums per (user, genre, era) from which :func:`genre_features` follow; sums of parts add up to those of the whole.

    Without ``exploded`` and ``genome`` the ratings list their genres with relevance (``silver.list_genres``).
    """
    decay = Decay(decay_per_day)
    seconds = epoch()

    # Ratings of movies without genres stay as a null genre: they still move the time the user was last seen.
    if exploded is None:
        described = ratings.select("*", F.inline_outer("genres"))
    else:
        described = ratings.join(with_relevance(exploded.select("movieId", "genre"), genome), "movieId", "left")
    return (
        described.groupBy("userId", "genre", decay.era(seconds).alias("era"))
        .agg(
            F.count(F.lit(1)).alias("watched"),
            F.sum("rating").alias("rating_sum"),
            F.sum(F.col("rating") * decay.within_era(seconds)).alias("decayed_sum"),
            F.sum("relevance").alias("relevance_sum"),
            F.count("relevance").alias("relevance_count"),
            F.max("timestamp").alias("last_rated"),
        )
    )


def tag_counts(tags: DataFrame, exploded: DataFrame) -> DataFrame:
    """How many different tags a user gave to movies of a genre.

    A user's different tags, with the genres of what they were given to, are gathered in one list, so they are moved
    once and not per genre; what a user repeats is dropped before the shuffle.
    """
    genres = exploded.groupBy("movieId").agg(F.array_sort(F.collect_set("genre")).alias("genres"))
    given = F.collect_set(F.struct("tag", "genres")).alias("given")
    tagged = tags.join(genres, "movieId").groupBy("userId").agg(given).select("userId", F.inline("given"))
    by_genre = tagged.select("userId", "tag", F.explode("genres").alias("genre"))
    return by_genre.groupBy("userId", "genre").agg(F.count_distinct("tag").alias("tag_count"))


def genre_features(rated: DataFrame, tagged: DataFrame, decay_per_day: float = DECAY_PER_DAY) -> DataFrame:
    """The seven features from sums per (user, genre, era), of one or several parts of the ratings, and tag counts.

    Everything stays in one partitioning by user.
    """
    decay = Decay(decay_per_day)
    of_user = Window.partitionBy("userId")
    recency = F.sum(F.col("decayed_sum") * decay.from_era(F.col("era"), F.unix_seconds("user_last")))
    combined = (
        rated.unionByName(tagged, allowMissingColumns=True)
        .withColumn("user_last", F.max("last_rated").over(of_user))
        .groupBy("userId", "genre")
        .agg(
            (F.sum("rating_sum") / F.sum("watched")).alias("genre_avg_rating"),
            F.sum("watched").alias("genre_watch_count"),
            (recency / F.sum("watched")).alias("genre_recency_score"),
            (F.sum("relevance_sum") / F.nullif(F.sum("relevance_count"), F.lit(0))).alias("genre_avg_genome_relevance"),
            F.coalesce(F.max("tag_count"), F.lit(0)).cast("long").alias("genre_tag_count"),
            F.max("last_rated").alias("feature_timestamp"),
        )
        .where(F.col("genre").isNotNull() & F.col("genre_watch_count").isNotNull())
    )
    share = F.col("genre_watch_count") / F.sum("genre_watch_count").over(of_user)
    entropy = F.lit(0.0) - F.sum(F.col("genre_share") * F.ln("genre_share")).over(of_user)
    return (
        combined.withColumn("genre_share", share)
        .withColumn("genre_diversity_index", entropy)
        .select(
            "userId",
            "genre",
            "genre_avg_rating",
            "genre_watch_count",
            "genre_recency_score",
            "genre_share",
            "genre_diversity_index",
            "genre_avg_genome_relevance",
            "genre_tag_count",
            "feature_timestamp",
        )
    )


def user_genre_features(
    ratings: DataFrame,
    exploded: DataFrame,
    genome: DataFrame,
    tags: DataFrame,
    decay_per_day: float = DECAY_PER_DAY,
) -> DataFrame:
    """The seven features of every (user, genre) the user has rated."""
    rated = genre_sums(ratings, exploded, genome, decay_per_day)
    return genre_features(rated, tag_counts(tags, exploded), decay_per_day)


def user_profile_features(ratings: DataFrame, exploded: DataFrame | None = None) -> DataFrame:
    """Per-user totals over all ratings, and variety over genres; users without any genre drop out."""
    seconds = epoch()
    totals = ratings.groupBy("userId").agg(
        F.count(F.lit(1)).alias("total_ratings"),
        F.avg("rating").alias("avg_rating"),
        ((F.max(seconds) - F.min(seconds)) / F.lit(SECONDS_PER_DAY)).alias("active_days"),
        F.max("timestamp").alias("profile_timestamp"),
    )
    # With counts n and their sum T, the entropy of the shares n/T is ln T - sum(n ln n)/T: one aggregate.
    n, total = F.col("n"), F.sum("n")
    variety = (
        per_genre(ratings, exploded)
        .groupBy("userId", "genre")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("userId")
        .agg(
            F.count("genre").alias("distinct_genres"),
            F.greatest(F.ln(total) - F.sum(n * F.ln(n)) / total, F.lit(0.0)).alias("diversity_index"),
        )
    )
    return totals.join(variety, "userId").select(
        "userId",
        "total_ratings",
        "avg_rating",
        "active_days",
        "distinct_genres",
        "diversity_index",
        "profile_timestamp",
    )
