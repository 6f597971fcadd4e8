"""Population stability of features against a stored baseline."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palate.functions.local import COUNT, NUMBER, NUMBERS, TEXT, local_frame
from palate.functions.quantiles import ValueRange, interpolated_quantiles
from palate.settings import GENRE_FEATURES, PSI_BINS, PSI_FLOOR, PSI_LIMIT
from palate.sources.scratch import staged


def feature_values(df: DataFrame, features: Sequence[str] = GENRE_FEATURES) -> DataFrame:
    """The numbers in the given columns as ``(key, value)`` rows, without nulls and NaN."""
    entries = [F.struct(F.lit(f).alias("key"), F.col(f).cast("double").alias("value")) for f in features]
    return df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull() & ~F.isnan("value"))


def _compare_counts(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """How often each ``(key, value)`` occurs on either side."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = baseline.select("key", "value", one.alias("base"), none.alias("now")).unionAll(
        current.select("key", "value", none.alias("base"), one.alias("now"))
    )
    return sides.groupBy("key", "value").agg(F.sum("base").alias("base"), F.sum("now").alias("now"))


def psi(
    baseline: DataFrame, current: DataFrame, keys: Sequence[str], bins: int = PSI_BINS, min_rows: int = 0
) -> DataFrame:
    """Population stability index of two ``(key, value)`` frames, for each of the given keys.

    Bins are the baseline's interpolated quantiles, equal edges merged; fewer than two bins make the index
    0. Values outside the baseline's range are left out. Keys with ``min_rows`` values or fewer on either
    side are left out of the result.

    A key with infinite values, or a range that a double cannot hold, has no bins: its index is null.

    Both sides shrink to counts per distinct value in one shuffle, which splits by value and so has no
    hot key; quantiles and histogram work on those counts. What comes back, or is broadcast, is bounded by the
    number of keys times the number of bins.
    """
    wanted = F.col("key").isin(*keys)
    with staged(_compare_counts(baseline.where(wanted), current.where(wanted)), "value-counts") as counts:
        in_baseline = F.when(F.col("base") > 0, F.col("value"))
        sizes = (
            counts.groupBy("key")
            .agg(
                F.sum("base").alias("base"),
                F.sum("now").alias("now"),
                F.min(in_baseline).alias("lo"),
                F.max(in_baseline).alias("hi"),
            )
            .where((F.col("base") > min_rows) & (F.col("now") > min_rows))
            .collect()
        )
        ranges = {row.key: ValueRange(row.base, row.lo, row.hi) for row in sizes if math.isfinite(row.hi - row.lo)}
        quantiles = interpolated_quantiles(
            counts.where(F.col("base") > 0).select("key", "value", F.col("base").alias("n")),
            ranges,
            [i / bins for i in range(bins + 1)],
        )
        edges = {key: sorted(set(points)) for key, points in quantiles.items()}
        binned = _histogram(counts, {key: e for key, e in edges.items() if len(e) > 2}, bins)
    endless = [row.key for row in sizes if row.key not in ranges]
    index = _index(baseline.sparkSession, list(ranges), binned)
    nothing = local_frame(baseline.sparkSession, {"key": TEXT}, [(key,) for key in endless])
    return index.unionByName(nothing.withColumn("psi", F.lit(None).cast("double")))


def _histogram(counts: DataFrame, edges: dict[str, list[float]], bins: int) -> list[tuple]:
    """``(key, base, now)`` of every bin, empty ones included: at most ``bins`` rows per key."""
    layout = local_frame(
        counts.sparkSession,
        {"key": TEXT, "low": NUMBER, "high": NUMBER, "inner": NUMBERS},
        [(key, e[0], e[-1] + 1e-6, e[1:-1]) for key, e in edges.items()],
    )
    above = [F.coalesce((F.col("value") >= F.get("inner", F.lit(i))).cast("int"), F.lit(0)) for i in range(bins - 1)]
    filled = (
        counts.join(F.broadcast(layout), "key")
        .where(F.col("value").between(F.col("low"), F.col("high")))
        .groupBy("key", sum(above, F.lit(0)).alias("bin"))
        .agg(F.sum("base").alias("base"), F.sum("now").alias("now"))
    )
    found = {(row.key, row.bin): (row.base, row.now) for row in filled.collect()}
    return [(key, *found.get((key, i), (0, 0))) for key, e in edges.items() for i in range(len(e) - 1)]


def _index(spark: SparkSession, keys: list[str], binned: list[tuple]) -> DataFrame:
    """The index per key from its bins, 0 for a key without."""
    of_key = Window.partitionBy("key")

    def proportion(side: str) -> Column:
        return (F.col(side) + F.lit(PSI_FLOOR)) / (
            F.sum(side).over(of_key) + F.count(F.lit(1)).over(of_key) * F.lit(PSI_FLOOR)
        )

    shift = (F.col("now") - F.col("base")) * F.ln(F.col("now") / F.col("base"))
    shifts = (
        local_frame(spark, {"key": TEXT, "base": COUNT, "now": COUNT}, binned)
        .select("key", proportion("base").alias("base"), proportion("now").alias("now"))
        .groupBy("key")
        .agg(F.sum(shift).alias("psi"))
    )
    every_key = local_frame(spark, {"key": TEXT}, [(key,) for key in keys])
    return every_key.join(shifts, "key", "left").select("key", F.coalesce("psi", F.lit(0.0)).alias("psi"))


def drift_report(
    baseline: DataFrame,
    current: DataFrame,
    features: Sequence[str] = GENRE_FEATURES,
    bins: int = PSI_BINS,
    limit: float = PSI_LIMIT,
) -> DataFrame:
    """PSI and verdict per feature that has more than ``bins`` values on both sides; no index counts as drift."""
    index = psi(feature_values(baseline, features), feature_values(current, features), features, bins, min_rows=bins)
    return index.select(
        F.col("key").alias("feature"), F.round("psi", 6).alias("psi"), F.coalesce(F.col("psi") > limit, F.lit(True)).alias("drifted")
    )


def drift_summary(report: DataFrame, features: Sequence[str] = GENRE_FEATURES) -> DataFrame:
    """One row for the log: PSI per feature as JSON in feature order, and whether any has drifted.

    Scores are overwritten by every run, so there is nothing to compare predictions with: their index is NaN.
    """
    order = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    entry = F.struct(order.alias("at"), "feature", F.col("psi").cast("decimal(18,6)").alias("psi"))
    by_feature = F.map_from_entries(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["feature"], e["psi"]))
    )
    return report.agg(
        F.to_json(by_feature).alias("feature_psi"),
        F.lit(float("nan")).alias("prediction_psi"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
    )
