"""Bronze to silver: de-duplication, category explosion, relevance, time split."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.functions.expressions import after, at_or_before
from palate.functions.quantiles import time_quantiles
from palate.settings import HOLDOUT_QUANTILE, NO_GENRES

_RATING_KEY = ("userId", "movieId")


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """Complete rows only, the newest per (user, movie), with a real timestamp.

    An aggregate rather than a ranking window: it combines before the shuffle, so a pair that makes up
    much of the table still arrives as one row per task. Ties on time go to the larger rating.
    """
    rest = [c for c in ratings.columns if c not in (*_RATING_KEY, "timestamp")]
    newest = F.max(F.struct("timestamp", *rest)).alias("newest")

    def final(name: str) -> Column:
        if name in _RATING_KEY:
            return F.col(name)
        value = F.col(f"newest.{name}")
        return (F.timestamp_seconds(value) if name == "timestamp" else value).alias(name)

    return ratings.where(_complete(ratings)).groupBy(*_RATING_KEY).agg(newest).select(*map(final, ratings.columns))


def _complete(df: DataFrame) -> Column:
    """No null and no NaN in any column, as separate conditions that reach the scan."""
    present = [F.col(c).isNotNull() for c in df.columns]
    numbers = [~F.isnan(name) for name, kind in df.dtypes if kind in ("double", "float")]
    return reduce(and_, [*present, *numbers])


def explode_genres(movies: DataFrame) -> DataFrame:
    """One row per movie and listed genre; movies without genres disappear."""
    return movies.select("movieId", "title", F.explode(F.split("genres", "[|]")).alias("genre")).where(
        F.col("genre") != NO_GENRES
    )


def list_genres(ratings: DataFrame, exploded: DataFrame, genome: DataFrame | None = None) -> DataFrame:
    """Ratings with the genres of their movie as a list ``genres`` of structs, and with ``genome`` their relevance.

    For ratings that several steps join to their genres: staged, they are moved to their movie once. Rows are dealt by
    user, those of a hot one to several tasks, so sums per user and genre that tasks form are nearly whole before they
    are shuffled. The list is null for movies without genres. Operators on ratings take the result with ``exploded``
    None.
    """
    genres = exploded.select("movieId", "genre")
    if genome is not None:
        genres = with_relevance(genres, genome)
    cells = F.struct(*[c for c in genres.columns if c != "movieId"])
    listed = genres.groupBy("movieId").agg(F.collect_list(cells).alias("genres"))
    return ratings.join(listed, "movieId", "left").select(*ratings.columns, "genres").hint("rebalance", F.col("userId"))


def with_relevance(genres: DataFrame, genome: DataFrame) -> DataFrame:
    """Movies and genres with their ``relevance``, null where it is not known."""
    # One relevance per movie and genre by construction: counts stay right whatever comes in, and the
    # optimizer knows that the join adds no rows, so it can tell whether the result is small enough to broadcast.
    relevance = genome.groupBy("movieId", "genre").agg(F.avg("avg_genome_relevance").alias("relevance"))
    return genres.join(relevance, ["movieId", "genre"], "left")


def keep_listed(ratings: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """Ratings of :func:`list_genres` without the excluded genres."""
    names = list(excluded)
    return ratings.withColumn("genres", F.filter("genres", lambda cell: ~cell["genre"].isin(*names)))


def per_genre(ratings: DataFrame, exploded: DataFrame | None) -> DataFrame:
    """A row per rating and genre of its movie; with ``exploded`` None the ratings are those of :func:`list_genres`."""
    if exploded is None:
        return ratings.select("*", F.inline("genres")).drop("genres")
    return ratings.join(exploded.select("movieId", "genre"), "movieId")


def filter_variant(exploded: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """The exploded movies without the excluded genres."""
    return exploded.where(~F.col("genre").isin(*excluded))


def aggregate_genome(scores: DataFrame, tags: DataFrame, exploded: DataFrame) -> DataFrame:
    """Mean tag relevance per (movie, genre) over scores whose tag is known.

    A movie's scores count equally for each of its genres, so they are averaged per movie first; only
    one row per movie meets the genres. A tag listed twice weighs twice, as in a plain join.
    """
    copies = tags.groupBy("tagId").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.when(F.col("relevance").isNotNull(), F.col("copies"))
    per_movie = (
        scores.join(copies, "tagId")
        .groupBy("movieId")
        .agg((F.sum(F.col("relevance") * F.col("copies")) / F.sum(weight)).alias("avg_genome_relevance"))
    )
    return (
        per_movie.join(exploded.select("movieId", "genre"), "movieId")
        .groupBy("movieId", "genre")
        .agg(F.first("avg_genome_relevance").alias("avg_genome_relevance"))
    )


def holdout_boundary(ratings: DataFrame, quantile: float = HOLDOUT_QUANTILE) -> int | None:
    """The time quantile in seconds, none if there are no ratings.

    A number, not a subquery: only a literal reaches the scan and lets it skip row groups.
    """
    row = time_quantiles(ratings, [quantile]).first()
    return row.epoch if row else None


def split_holdout(ratings: DataFrame, quantile: float = HOLDOUT_QUANTILE) -> tuple[DataFrame, DataFrame]:
    """Ratings up to the time quantile, and those after it. Both are empty if there are none."""
    boundary = holdout_boundary(ratings, quantile)
    if boundary is None:
        return ratings.where(F.lit(False)), ratings.where(F.lit(False))
    return ratings.where(at_or_before(boundary)), ratings.where(after(boundary))
