"""Long (user, genre) cells to one wide row per user, and back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.settings import GENRE_FEATURES, PROFILE_FEATURES


def pivot_labels(cells: DataFrame, genres: Iterable[str], value: str = "label") -> DataFrame:
    """``userId`` plus one column per genre in name order: the mean of the cell, 0 where there is none.

    Users whose cells are all in other genres keep an all-zero row.
    """
    by_user = cells.select("userId", "genre", value).repartition("userId")
    return by_user.groupBy("userId").pivot("genre", sorted(genres)).agg(F.avg(value)).na.fill(0.0)


def feature_columns(genres: Iterable[str]) -> list[str]:
    """The columns of :func:`pivot_features` after ``userId``, in the order a model sees them."""
    ordered = sorted(genres)
    return [*PROFILE_FEATURES, *(f"{feature}_{genre}" for feature in GENRE_FEATURES for genre in ordered)]


def _mean(cells: Column, genre: Column, value: str) -> Column:
    """The mean of a value over the cells of a genre that have one, null if none has."""
    own = F.transform(F.filter(cells, lambda cell: cell["genre"] == genre), lambda cell: cell["values"][value])
    known = F.filter(own, lambda x: x.isNotNull())
    return F.aggregate(known, F.lit(0.0), lambda total, x: total + x) / F.nullif(F.size(known), F.lit(0))


def _wide(cells: DataFrame, keys: Sequence[str], genres: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``keys`` and ``cells``, which holds a struct of the means of ``values`` per listed genre, in the order of ``genres``.

    A user's cells are gathered in one list, at most one per genre as a rule; only where a genre is repeated are its
    cells averaged, instead of grouping all cells by genre first.
    """
    cell = F.struct("genre", F.struct(*[F.col(v).cast("double").alias(v) for v in values]).alias("values"))
    listed = cells.groupBy(*keys).agg(F.collect_list(F.when(F.col("genre").isin(*genres), cell)).alias("cells"))
    gathered = F.col("cells")
    different = F.array_distinct(F.col("cells.genre"))
    averaged = F.transform(different, lambda g: F.struct(*[_mean(gathered, g, v).alias(v) for v in values]))
    by_genre = F.when(F.size(different) == F.size(gathered), F.map_from_entries(gathered)).otherwise(
        F.map_from_arrays(different, averaged)
    )
    ordered = F.transform(F.array(*map(F.lit, genres)), lambda genre: F.element_at("by_genre", genre))
    return listed.select(*keys, by_genre.alias("by_genre")).select(*keys, ordered.alias("cells"))


def pivot_features(cells: DataFrame, genres: Iterable[str]) -> DataFrame:
    """``userId``, the profile columns, and a column ``feature_genre`` per feature and listed genre.

    The columns depend on ``genres`` alone: a genre nobody has is a column of zeros, a genre that is not
    listed gets none, so training and scoring always agree. Profile values repeat on all cells of a user
    and therefore join the grouping key. Cells that come by user, as those of a join by user do, are not shuffled.
    """
    return _pivot(cells, sorted(genres), (), GENRE_FEATURES, feature_columns(genres))


def pivot_training(cells: DataFrame, genres: Iterable[str], by: Sequence[str] = ()) -> DataFrame:
    """``userId``, ``by``, the columns of :func:`pivot_features`, and a column ``target_genre`` per listed genre.

    Features and labels in one pass, for cells that hold both. Cells that come by user, as those of a lookup do, are
    not shuffled.
    """
    ordered = sorted(genres)
    names = [*feature_columns(ordered), *target_columns(ordered)]
    return _pivot(cells, ordered, by, (*GENRE_FEATURES, "label"), names)


def _pivot(
    cells: DataFrame, genres: Sequence[str], by: Sequence[str], values: Sequence[str], names: Sequence[str]
) -> DataFrame:
    wide = _wide(cells, ["userId", *by, *PROFILE_FEATURES], genres, values)
    profile = [F.col(c).cast("double") for c in PROFILE_FEATURES]
    own = [F.col("cells")[place][value] for value in values for place in range(len(genres))]
    filled = [F.coalesce(c, F.lit(0.0)).alias(n) for c, n in zip([*profile, *own], names, strict=True)]
    return wide.select("userId", *by, *filled)


def target_columns(genres: Iterable[str]) -> list[str]:
    """The label columns of :func:`pivot_training`, in the order of a model's scores."""
    return [f"target_{genre}" for genre in sorted(genres)]


def melt(wide: DataFrame, genres: Sequence[str], **values: str) -> DataFrame:
    """One row per user and genre. ``values`` maps an output column to the prefix of its wide columns.

    Generated row by row: neither a shuffle nor a join, and the partitioning by user survives.
    """
    cells = [
        F.struct(F.lit(genre).alias("genre"), *[F.col(f"`{prefix}{genre}`").alias(n) for n, prefix in values.items()])
        for genre in sorted(genres)
    ]
    return wide.select("userId", F.inline(F.array(*cells)))


def dense_cells(cells: DataFrame, genres: Sequence[str]) -> DataFrame:
    """Every listed genre of every user with its mean label ``y``, 0 where the user has none."""
    return melt(pivot_labels(cells, genres), genres, y="")


def prediction_cells(labels: DataFrame, genres: Sequence[str], **predictions: DataFrame) -> DataFrame:
    """Labels ``y`` next to named predictions as cells, e.g. ``p=scores, champion=other_scores``.

    All inputs are wide and meet once per user.
    """
    ordered = sorted(genres)

    def prefixed(wide: DataFrame, prefix: str) -> DataFrame:
        return wide.select("userId", *[F.col(f"`{g}`").alias(f"{prefix}{g}") for g in ordered])

    joined = prefixed(labels, "y_")
    for name, scores in predictions.items():
        joined = joined.join(prefixed(scores, f"{name}_"), "userId")
    return melt(joined, ordered, y="y_", **{name: f"{name}_" for name in predictions})
