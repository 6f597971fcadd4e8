"""Landing files to silver and gold tables."""

from __future__ import annotations

from palate import settings
from palate.operators.features import genre_features, genre_sums, sample_users, tag_counts, user_profile_features
from palate.operators.labels import split_boundaries
from palate.operators.silver import (
    aggregate_genome,
    clean_ratings,
    explode_genres,
    filter_variant,
    list_genres,
    split_holdout,
)
from palate.sources.csv import ingest_missing
from palate.sources.scratch import staged
from palate.sources.tables import TableStore
from palate.streaming.replay import restart


def bootstrap(store: TableStore, landing: str) -> None:
    """Load missing bronze tables and rebuild silver."""
    ingest_missing(store, landing)
    build_silver(store)


def build_silver(store: TableStore, holdout_quantile: float = settings.HOLDOUT_QUANTILE) -> None:
    """Rebuild the silver tables from bronze and start a new replay of the held-out ratings."""
    exploded = store.overwrite(settings.MOVIES_EXPLODED, explode_genres(store.read("bronze.movies")))
    store.overwrite(settings.MOVIES_EXPLODED_NOKIDS, filter_variant(exploded, settings.NOKIDS_EXCLUDED))
    store.overwrite(
        settings.GENOME_AGG,
        aggregate_genome(store.read("bronze.genome_scores"), store.read("bronze.genome_tags"), exploded),
    )
    with staged(clean_ratings(store.read("bronze.ratings")), "ratings-clean") as complete:
        training, holdout = split_holdout(complete, holdout_quantile)
        store.overwrite(settings.RATINGS_HOLDOUT, holdout)
        restart(store)
        store.overwrite_sliced(settings.RATINGS_CLEAN, training)


def build_user_features(store: TableStore, fraction: float = 1.0) -> None:
    """Compute the features per (user, genre) and per user of a sample of users and merge them into the tables.

    Both read one copy of the ratings that lists their genres, so ratings are moved to their movie once.
    """
    exploded = store.read(settings.MOVIES_EXPLODED)
    ratings = sample_users(store.read(settings.RATINGS_CLEAN), fraction)
    listed = list_genres(ratings, exploded, store.read(settings.GENOME_AGG)).drop("movieId")
    with staged(listed, "described") as described:
        tagged = tag_counts(sample_users(store.read("bronze.tags"), fraction), exploded)
        store.upsert(settings.USER_GENRE_FEATURES, genre_features(genre_sums(described), tagged), ["userId", "genre"])
        store.upsert(settings.USER_PROFILE_FEATURES, user_profile_features(described), ["userId"])


def build_features(store: TableStore, fraction: float = 1.0) -> None:
    """Refresh both feature tables and the time boundaries of the training splits."""
    build_user_features(store, fraction)
    build_boundaries(store)


def build_boundaries(store: TableStore) -> None:
    """Store the time boundaries of the training splits."""
    store.overwrite(settings.SPLIT_METADATA, split_boundaries(store.read(settings.RATINGS_CLEAN)))
