"""What changed between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row per key whose rows differ: the keys, ``change``, ``changed_columns``, ``rows_before``, ``rows_after``.

    ``change`` is added, removed or changed. Rows of a key are compared as a bag: order does not count, duplicates do.
    Columns are named where both sides have one row, and null otherwise. Nulls equal nulls, in keys as in columns, and
    NaN equals NaN. Each side is reduced to a row per key before the sides meet.
    """
    keys = list(keys)
    columns = [c for c in before.columns if c not in keys]
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the versions have different columns")

    def cells() -> list[Column]:
        # A hash passes over nulls, so that a value is null is hashed as well.
        return [x for c in columns for x in (F.col(c), F.col(c).isNull())]

    def reduced(df: DataFrame, side: str) -> DataFrame:
        first, second = F.xxhash64(F.lit(1), *cells()), F.hash(F.lit(2), *cells()).cast("long")
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"rows_{side}"),
            # Sums of hashes, which do not depend on the order and tell one row from two.
            F.sum((F.pmod(first, F.lit(1 << 40))).cast("long")).alias(f"__{side}_a"),
            F.sum(F.shiftrightunsigned(first, 40) + F.pmod(second, F.lit(1 << 32)) * F.lit(1 << 24)).cast("decimal(38,0)").alias(
                f"__{side}_b"
            ),
            F.min(F.struct(*columns)).alias(f"__{side}_row"),
        )

    old = reduced(before, "before").select(*[F.col(k).alias(f"__old_{k}") for k in keys], F.col("*")).drop(*keys)
    new = reduced(after, "after")
    meets = F.lit(True)
    for key in keys:
        meets = meets & F.col(f"__old_{key}").eqNullSafe(F.col(key))
    joined = old.join(new, meets, "full")
    counts = [F.coalesce(F.col(f"rows_{side}"), F.lit(0)).alias(f"rows_{side}") for side in ("before", "after")]
    same = F.lit(True)
    for name in ("rows_{}", "__{}_a", "__{}_b"):
        same = same & F.col(name.format("before")).eqNullSafe(F.col(name.format("after")))
    differs = [
        F.when(~F.col(f"__before_row.{c}").eqNullSafe(F.col(f"__after_row.{c}")), F.lit(c)) for c in columns
    ]
    one_each = (F.col("rows_before") == 1) & (F.col("rows_after") == 1)
    change = (
        F.when(F.col("rows_before").isNull(), "added").when(F.col("rows_after").isNull(), "removed").otherwise("changed")
    )
    # A key that is null on both sides is on both rows, so a side's own key tells.
    own_key = [
        F.when(F.col("rows_after").isNotNull(), F.col(key)).otherwise(F.col(f"__old_{key}")).alias(key) for key in keys
    ]
    return joined.where(~same).select(
        *own_key,
        change.alias("change"),
        F.when(one_each, F.array_compact(F.array(*differs))).alias("changed_columns"),
        *counts,
    )
