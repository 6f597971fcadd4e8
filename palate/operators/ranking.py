"""Ranks over a whole table, and the best rows of each group, ties included."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.sources.scratch import stage


def global_ranks(df: DataFrame, score: str) -> DataFrame:
    """``df`` with ``rank`` and ``dense_rank`` of ``score``, highest first, nulls last.

    Equal scores are counted before anything is ordered, so a score that many rows share is one row. The different
    scores are dealt into ranges; a range ranks its own and adds what the ranges above it hold, one number each, which
    is all that reaches the driver. No window runs over the whole table.
    """
    counted = df.groupBy(F.col(score).alias("__score")).agg(F.count(F.lit(1)).alias("__n"))
    order = F.col("__score").desc_nulls_last()
    ranges = stage(
        counted.repartitionByRange(order).withColumn("__range", F.spark_partition_id()), "score-ranges"
    )
    totals = ranges.groupBy("__range").agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("scores")).collect()
    rows_above, scores_above, above = 0, 0, []
    for total in sorted(totals, key=lambda t: t["__range"]):
        above.append((total["__range"], rows_above, scores_above))
        rows_above, scores_above = rows_above + total["rows"], scores_above + total["scores"]
    offsets = df.sparkSession.createDataFrame(above, "__range int, __rows long, __scores long")
    within = Window.partitionBy("__range").orderBy(order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, as many as there are shuffle partitions.
    placed = (
        ranges.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn("__place", F.row_number().over(within))
        .join(F.broadcast(offsets), "__range")
        .select(
            "__score",
            (F.col("__rows") + F.col("__before") + 1).alias("rank"),
            (F.col("__scores") + F.col("__place")).alias("dense_rank"),
        )
    )
    # Staged, so that adaptive execution may split the rows of a hot score.
    placed = stage(placed, "score-ranks")
    return df.join(placed, F.col(score).eqNullSafe(F.col("__score"))).drop("__score")


def leaders(df: DataFrame, score: str, most: int) -> DataFrame:
    """The rows whose global rank is at most ``most``; ties of the last one come along."""
    return global_ranks(df, score).where(F.col("rank") <= most)


def best_of_group(df: DataFrame, group: str, score: str, most: int) -> DataFrame:
    """The rows of each group whose rank in it is at most ``most``, ties included, as ``group_rank``."""
    # One row per group and score; no more than ``most`` scores of a group can be among its best, and every task drops
    # the others before they are shuffled.
    counted = df.groupBy(group, score).agg(F.count(F.lit(1)).alias("__n"))
    best = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last())
    few = counted.withColumn("__place", F.row_number().over(best)).where(F.col("__place") <= most)
    above = F.sum("__n").over(best.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        few.withColumn("group_rank", 1 + F.coalesce(above, F.lit(0)))
        .where(F.col("group_rank") <= most)
        .select(F.col(group).alias("__group"), F.col(score).alias("__score"), "group_rank")
    )
    ranked = stage(ranked, "group-ranks")
    meets = F.col(group).eqNullSafe(F.col("__group")) & F.col(score).eqNullSafe(F.col("__score"))
    return df.join(ranked, meets).drop("__group", "__score")
