"""The checks a set of predictions must pass before it may replace the current one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.operators.metrics import at_most, label_spread, r_squared, squared_error
from palate.settings import GENRE_RMSE_LIMIT, R2_LIMIT, RMSE_LIMIT, SLICE_R2_LIMIT


def validation_report(cells: DataFrame) -> DataFrame:
    """One row per variant and check: value, threshold and whether it passed (null when skipped).

    ``cells`` holds ``variant, genre, slice, y, p, champion``; ``champion`` is null where there is none.
    Grouping sets give the sums per genre, over all users and per activity slice, in a single pass; the
    rest works on one row per genre and slice.
    """
    per_genre = cells.groupingSets(
        [["variant", "genre"], ["variant", "genre", "slice"]], "variant", "genre", "slice"
    ).agg(
        F.grouping("slice").alias("whole"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("p").isNotNull() & ~F.isnan("p")).alias("usable"),
        squared_error().alias("sse"),
        label_spread().alias("sst"),
        F.count("champion").alias("champion_cells"),
        squared_error("champion").alias("champion_sse"),
    )
    r2 = r_squared(F.col("n"), F.col("sse"), F.col("sst"))
    per_slice = per_genre.groupBy("variant", "whole", "slice").agg(
        F.sum("n").alias("n"),
        F.sum("usable").alias("usable"),
        F.sum("sse").alias("sse"),
        F.avg(r2).alias("r2"),
        F.max(F.sqrt(F.col("sse") / F.col("n"))).alias("worst_genre"),
        F.sum("champion_cells").alias("champion_cells"),
        F.sum("champion_sse").alias("champion_sse"),
    )

    def overall(value: Column) -> Column:
        return F.max(F.when(F.col("whole") == 1, value))

    per_variant = per_slice.groupBy("variant").agg(
        overall(F.col("usable").cast("double")).alias("usable"),
        overall(F.sqrt(F.col("sse") / F.col("n"))).alias("rmse"),
        overall(F.col("r2")).alias("r2"),
        overall(F.col("worst_genre")).alias("worst_genre"),
        overall(F.when(F.col("champion_cells") > 0, F.sqrt(F.col("champion_sse") / F.col("n")))).alias("champion"),
        F.min(F.when(F.col("whole") == 0, F.col("r2"))).alias("worst_slice"),
        F.bool_or((F.col("whole") == 0) & F.isnan("sse")).alias("broken_slice"),
    )

    def check(name: str, value: str, limit: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.col(value).alias("value"),
            limit.alias("threshold"),
            passed.alias("passed"),
        )

    # An R² that is undefined for lack of rows passes; a missing prediction makes errors NaN and fails.
    checks = [
        check("smoke_test", "usable", F.lit(1.0), F.col("usable") >= 1),
        check("rmse", "rmse", F.lit(RMSE_LIMIT), F.col("rmse") < RMSE_LIMIT),
        check("r2", "r2", F.lit(R2_LIMIT), ~(F.col("r2") <= R2_LIMIT) & ~F.isnan("rmse")),
        check("champion", "rmse", F.col("champion"), at_most(F.col("rmse"), F.col("champion"))),
        check("genre_rmse", "worst_genre", F.lit(GENRE_RMSE_LIMIT), F.col("worst_genre") <= GENRE_RMSE_LIMIT),
        check(
            "slice_r2",
            "worst_slice",
            F.lit(SLICE_R2_LIMIT),
            ~(F.col("worst_slice") < SLICE_R2_LIMIT) & ~F.col("broken_slice"),
        ),
    ]
    return per_variant.select("variant", F.inline(F.array(*checks)))


def variant_status(report: DataFrame) -> DataFrame:
    """PASSED or FAILED per variant; skipped checks do not count."""
    passed = F.bool_and(F.coalesce(F.col("passed"), F.lit(True)))
    return report.groupBy("variant").agg(F.when(passed, "PASSED").otherwise("FAILED").alias("status"))


def promotion_gate(report: DataFrame, variants: Sequence[str]) -> DataFrame:
    """One row: promote only if every expected variant has been validated and has passed."""
    passed = F.count_if((F.col("status") == "PASSED") & F.col("variant").isin(*variants))
    return (
        variant_status(report)
        .agg(passed.alias("variants_passed"))
        .withColumn("promoted", F.col("variants_passed") == len(variants))
    )
