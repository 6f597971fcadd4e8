"""Features from stored sums, to which a day adds the sums of its own ratings.

The clean ratings grow by slices, one per replayed window. For each slice, sums per (user, genre) and per user are
stored under the same id, so a repeated run replaces what it wrote and adds nothing twice; only ratings of new slices
are ever read. Features follow from the stored sums. ``compact`` puts the sums of all slices together under the last
of their ids; slices up to that one count as done.

Each user and movie has one clean rating, so ratings are only ever added. Tags are counted when sums start anew, and
relevance is that of the store when a slice is summed; after they change, start anew with ``rebuild``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate import settings
from palate.functions.expressions import epoch
from palate.operators.features import genre_features, genre_sums, tag_counts
from palate.sources.tables import TableStore
from palate.streaming.replay import advance

_ADDED = ("watched", "rating_sum", "decayed_sum", "relevance_sum", "relevance_count")


def user_sums(ratings: DataFrame) -> DataFrame:
    """Sums per user from which profiles follow, together with those per genre."""
    seconds = epoch()
    return ratings.groupBy("userId").agg(
        F.count(F.lit(1)).alias("ratings"),
        F.sum("rating").alias("rating_sum"),
        F.min(seconds).alias("first_seconds"),
        F.max(seconds).alias("last_seconds"),
        F.max("timestamp").alias("last_rated"),
    )


def merged_genre_sums(parts: DataFrame) -> DataFrame:
    added = [F.sum(c).alias(c) for c in _ADDED]
    return parts.groupBy("userId", "genre", "era").agg(*added, F.max("last_rated").alias("last_rated"))


def merged_user_sums(parts: DataFrame) -> DataFrame:
    return parts.groupBy("userId").agg(
        F.sum("ratings").alias("ratings"),
        F.sum("rating_sum").alias("rating_sum"),
        F.min("first_seconds").alias("first_seconds"),
        F.max("last_seconds").alias("last_seconds"),
        F.max("last_rated").alias("last_rated"),
    )


def profile_features(of_users: DataFrame, of_genres: DataFrame) -> DataFrame:
    """The profile of every user with a genre, from sums per user and per (user, genre)."""
    n, total = F.col("n"), F.sum("n")
    variety = (
        of_genres.where(F.col("genre").isNotNull())
        .groupBy("userId", "genre")
        .agg(F.sum("watched").alias("n"))
        .groupBy("userId")
        .agg(
            F.count("genre").alias("distinct_genres"),
            F.greatest(F.ln(total) - F.sum(n * F.ln(n)) / total, F.lit(0.0)).alias("diversity_index"),
        )
    )
    days = (F.col("last_seconds") - F.col("first_seconds")) / F.lit(settings.SECONDS_PER_DAY)
    return merged_user_sums(of_users).join(variety, "userId").select(
        "userId",
        F.col("ratings").alias("total_ratings"),
        (F.col("rating_sum") / F.col("ratings")).alias("avg_rating"),
        days.alias("active_days"),
        "distinct_genres",
        "diversity_index",
        F.col("last_rated").alias("profile_timestamp"),
    )


def _sums_of(store: TableStore, ratings: DataFrame) -> dict[str, DataFrame]:
    exploded, genome = store.read(settings.MOVIES_EXPLODED), store.read(settings.GENOME_AGG)
    return {
        settings.USER_GENRE_STATE: genre_sums(ratings, exploded, genome),
        settings.USER_STATE: user_sums(ratings),
    }


def _tag_counts(store: TableStore) -> DataFrame:
    return tag_counts(store.read("bronze.tags"), store.read(settings.MOVIES_EXPLODED))


def rebuild(store: TableStore) -> None:
    """Start anew with the sums of all clean ratings and the tag counts there are."""
    store.overwrite(settings.USER_TAG_STATE, _tag_counts(store))
    last = store.slices(settings.RATINGS_CLEAN)[-1]
    for name, sums in _sums_of(store, store.read(settings.RATINGS_CLEAN)).items():
        store.overwrite_sliced(name, sums, last)


def absorb(store: TableStore) -> list[int]:
    """Store the sums of the slices of clean ratings that have none yet; returns their ids."""
    names = (settings.USER_GENRE_STATE, settings.USER_STATE)
    if not all(map(store.slices, names)) or not store.exists(settings.USER_TAG_STATE):
        rebuild(store)
        return store.slices(settings.RATINGS_CLEAN)
    added = set()
    for name in names:
        # Compacted sums stand under the last id they hold.
        held = store.slices(name)
        for slice_id in store.slices(settings.RATINGS_CLEAN):
            if slice_id > held[0] and slice_id not in held:
                sums = _sums_of(store, store.read_slice(settings.RATINGS_CLEAN, slice_id))[name]
                store.write_slice(name, sums, slice_id)
                added.add(slice_id)
    return sorted(added)


def compact(store: TableStore) -> None:
    """Put the sums of all slices together, so that reading them does not grow with the number of days."""
    merges = {settings.USER_GENRE_STATE: merged_genre_sums, settings.USER_STATE: merged_user_sums}
    for name, merge in merges.items():
        store.overwrite_sliced(name, merge(store.read(name)), store.slices(name)[-1])


def features(store: TableStore) -> tuple[DataFrame, DataFrame]:
    """Features per (user, genre) and profiles, from the stored sums."""
    of_genres = store.read(settings.USER_GENRE_STATE)
    tagged = store.read(settings.USER_TAG_STATE)
    return genre_features(of_genres, tagged), profile_features(store.read(settings.USER_STATE), of_genres)


def simulate_day(store: TableStore, days: int = settings.REPLAY_DAYS) -> int | str:
    """Let the next window of held-out ratings arrive and refresh the features from it; returns the window's end."""
    moved = advance(store, days)
    absorb(store)
    for name, df in zip((settings.USER_GENRE_FEATURES, settings.USER_PROFILE_FEATURES), features(store), strict=True):
        store.overwrite(name, df)
    return moved
