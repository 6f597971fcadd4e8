"""Time splits, labels, and their lookups into the feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.functions.expressions import after, at_or_before, epoch
from palate.functions.quantiles import time_quantiles
from palate.operators.silver import per_genre
from palate.settings import TEST_QUANTILE, TRAIN_QUANTILE


def split_boundaries(ratings: DataFrame, train: float = TRAIN_QUANTILE, test: float = TEST_QUANTILE) -> DataFrame:
    """One row of metadata: when it was computed, both time quantiles, row count and time range."""

    def at(position: int) -> Column:
        return F.max(F.when(F.col("position") == position, F.col("epoch")))

    return (
        time_quantiles(ratings, [train, test])
        .groupBy("row_count", "min_epoch", "max_epoch")
        .agg(at(0).alias("train_boundary_ts"), at(1).alias("holdout_boundary_ts"))
        .select(
            F.current_timestamp().alias("computed_at"),
            "train_boundary_ts",
            "holdout_boundary_ts",
            F.col("row_count").alias("ratings_clean_row_count"),
            F.col("min_epoch").alias("min_timestamp"),
            F.col("max_epoch").alias("max_timestamp"),
        )
    )


def training_labels(
    ratings: DataFrame, exploded: DataFrame | None, train_boundary: Column | int, holdout_boundary: Column | int
) -> DataFrame:
    """Mean rating per (user, genre) and time split."""
    flag = (
        F.when(at_or_before(train_boundary), "train").when(at_or_before(holdout_boundary), "val").otherwise("test")
    )
    return (
        per_genre(ratings, exploded)
        .groupBy("userId", "genre", flag.alias("split_flag"))
        .agg(F.avg("rating").alias("label"))
        .select("userId", "genre", "label", "split_flag")
    )


def train_val_only(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("split_flag").isin("train", "val"))


def restrict_to_feature_users(labels: DataFrame, profiles: DataFrame) -> DataFrame:
    """Labels of users that have a profile."""
    return labels.join(profiles.select("userId"), "userId", "left_semi")


def lookup_features(rows: DataFrame, user_genre: DataFrame, profiles: DataFrame) -> DataFrame:
    """Attach both feature tables to (user, genre) rows; what is missing stays null.

    The tables hold one current row per key, so this is not a point-in-time lookup. The features of a user, one row
    per genre, meet the user's rows as a list: both joins are by user, so rows are moved once and features that come
    by user not at all.
    """
    values = [c for c in user_genre.columns if c not in ("userId", "genre")]
    of_user = user_genre.groupBy("userId").agg(F.collect_list(F.struct("genre", *values)).alias("__features"))
    own = F.filter("__features", lambda cell: cell["genre"] == F.col("genre"))
    own = F.transform(own, lambda cell: F.struct(*[cell[c].alias(c) for c in values]))
    others = [c for c in rows.columns if c not in ("userId", "genre")]
    described = [c for c in profiles.columns if c != "userId"]
    joined = rows.join(profiles, "userId", "left").join(of_user, "userId", "left")
    return joined.select("userId", "genre", *others, *described, F.inline_outer(own))


def training_set(labels: DataFrame, user_genre: DataFrame, profiles: DataFrame) -> DataFrame:
    """Labels with features, without users that have no profile."""
    return lookup_features(labels, user_genre, profiles).na.drop(subset=["total_ratings"])


def holdout_ratings(ratings: DataFrame, exploded: DataFrame | None, boundary: Column | int) -> DataFrame:
    """Ratings after the boundary, one row per genre."""
    return per_genre(ratings.where(after(boundary)), exploded)


def holdout_cells(ratings: DataFrame, exploded: DataFrame | None, boundary: Column | int) -> DataFrame:
    """Mean rating per (user, genre) after the boundary."""
    return (
        holdout_ratings(ratings, exploded, boundary).groupBy("userId", "genre").agg(F.avg("rating").alias("label"))
    )


def holdout_metadata(
    ratings: DataFrame, exploded: DataFrame | None, profiles: DataFrame, boundary: Column | int
) -> DataFrame:
    """Size of the test set in cells and users, and the time range of its ratings.

    Cells and users are counted for users with a profile, the time range covers every rating in the window.
    """
    seconds = epoch()
    per_user = (
        holdout_ratings(ratings, exploded, boundary)
        .groupBy("userId", "genre")
        .agg(F.min(seconds).alias("first"), F.max(seconds).alias("last"))
        .groupBy("userId")
        .agg(F.count(F.lit(1)).alias("cells"), F.min("first").alias("first"), F.max("last").alias("last"))
        .join(profiles.select("userId", F.lit(True).alias("known")), "userId", "left")
    )
    return per_user.agg(
        F.coalesce(F.sum(F.when(F.col("known"), F.col("cells"))), F.lit(0)).cast("long").alias("holdout_row_count"),
        F.count("known").alias("holdout_user_count"),
        F.min("first").alias("holdout_min_timestamp"),
        F.max("last").alias("holdout_max_timestamp"),
    )
