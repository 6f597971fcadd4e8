"""Regression metrics over (user, genre) cells with a label ``y`` and a prediction ``p``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.settings import HIGH_ACTIVITY, LOW_ACTIVITY, SLICE_R2_LIMIT

_NAN = float("nan")


def squared_error(prediction: str = "p") -> Column:
    """Sum of squared errors. A missing prediction counts as NaN, so it cannot go unnoticed."""
    return F.sum(F.pow(F.col("y") - F.coalesce(F.col(prediction), F.lit(_NAN)), F.lit(2.0)))


def at_most(value: Column, limit: Column) -> Column:
    """``value <= limit`` where NaN on either side fails; null where there is no limit."""
    return F.when(limit.isNotNull(), ~F.isnan(value) & ~F.isnan(limit) & (value <= limit))


def label_spread() -> Column:
    """Sum of squared distances of the labels from their mean."""
    return F.var_pop("y") * F.count("y")


def r_squared(n: Column, sse: Column, sst: Column) -> Column:
    """1 - SSE/SST; a constant label scores 1 if met exactly and 0 otherwise; undefined below two rows."""
    return F.when(n < 2, _NAN).when(sst > 0, F.lit(1.0) - sse / sst).when(sse == 0, 1.0).otherwise(0.0)


def _per_genre(cells: DataFrame, *by: str) -> DataFrame:
    return (
        cells.groupBy(*by, "genre")
        .agg(F.count(F.lit(1)).alias("n"), squared_error().alias("sse"), label_spread().alias("sst"))
        .withColumn("r2", r_squared(F.col("n"), F.col("sse"), F.col("sst")))
    )


def metrics_per_genre(cells: DataFrame) -> DataFrame:
    """Root mean squared error of each genre."""
    return _per_genre(cells).select("genre", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))


def metrics_overall(cells: DataFrame) -> DataFrame:
    """One row: RMSE over all cells, and R² as the plain mean over genres."""
    return _per_genre(cells).agg(
        F.sqrt(F.sum("sse") / F.sum("n")).alias("rmse_overall"), F.avg("r2").alias("r2_overall")
    )


def compare_champion(cells: DataFrame) -> DataFrame:
    """One row: RMSE of ``p`` and of ``champion`` on the same cells; only a strictly worse ``p`` fails.

    Without any champion prediction the comparison is skipped: its RMSE and the verdict are null. A missing
    prediction of either side makes its RMSE NaN, and the challenger fails.
    """
    count, challenger = F.count(F.lit(1)), F.col("challenger_rmse")
    champion = F.when(F.count("champion") > 0, F.sqrt(squared_error("champion") / count))
    return cells.agg(
        F.sqrt(squared_error() / count).alias("challenger_rmse"), champion.alias("champion_rmse")
    ).withColumn("passed", at_most(challenger, F.col("champion_rmse")))


def with_activity(
    cells: DataFrame, ratings: DataFrame, low: int = LOW_ACTIVITY, high: int = HIGH_ACTIVITY
) -> DataFrame:
    """Add the user's activity ``slice``: fewer than ``low`` ratings, up to ``high``, or more."""
    totals = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("ratings"))
    count = F.coalesce(F.col("ratings"), F.lit(0))
    activity = F.when(count < low, "low").when(count <= high, "medium").otherwise("high")
    return cells.join(totals, "userId", "left").withColumn("slice", activity).drop("ratings")


def activity_slices(
    cells: DataFrame, ratings: DataFrame, low: int = LOW_ACTIVITY, high: int = HIGH_ACTIVITY
) -> DataFrame:
    """R² (mean over genres) of each activity slice that has users, and whether it is acceptable.

    A slice whose R² is undefined for lack of users passes; one with a missing prediction fails.
    """
    return (
        _per_genre(with_activity(cells, ratings, low, high), "slice")
        .groupBy("slice")
        .agg(F.max("n").alias("users"), F.avg("r2").alias("r2"), F.sum("sse").alias("sse"))
        .withColumn("passed", ~(F.col("r2") < SLICE_R2_LIMIT) & ~F.isnan("sse"))
        .drop("sse")
    )


def smoke_test(cells: DataFrame) -> DataFrame:
    """One row: how many predictions there are, how many are numbers, and whether any is."""
    usable = F.count_if(F.col("p").isNotNull() & ~F.isnan("p"))
    return cells.agg(F.count(F.lit(1)).alias("predictions"), usable.alias("usable")).withColumn(
        "passed", F.col("usable") > 0
    )
