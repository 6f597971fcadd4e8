"""Column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palate.settings import SECONDS_PER_DAY

# exp() of this is far from overflow, and losing it costs no more than 1e-14 of relative precision.
_MAX_EXPONENT = 50.0


def epoch(column: str = "timestamp") -> Column:
    """Whole seconds since 1970 of a timestamp column."""
    return F.unix_seconds(column)


def at_or_before(boundary: Column | int, column: str = "timestamp") -> Column:
    """``epoch(column) <= boundary``, written on the column itself so that parquet can skip row groups."""
    return F.col(column) < F.timestamp_seconds(_as_column(boundary) + 1)


def after(boundary: Column | int, column: str = "timestamp") -> Column:
    """``epoch(column) > boundary``, written on the column itself so that parquet can skip row groups."""
    return F.col(column) >= F.timestamp_seconds(_as_column(boundary) + 1)


def _as_column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("long")


def in_sample(key: str, fraction: float, seed: int) -> Column:
    """True for a fixed pseudo-random ``fraction`` of the keys.

    The decision is a function of the key alone: it needs no distinct, no join and no shuffle, and
    is the same in every table, partitioning and retry.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return bucket < F.lit(int(fraction * 2**32))


class Decay:
    """Exponential decay towards a reference time that is only known after aggregation.

    ``exp(-rate * (latest - t))`` needs the user's latest rating, which would mean joining every rating
    to its user's maximum. Splitting time into eras with an anchor each gives
    ``exp(rate * (t - anchor)) * exp(-rate * (latest - anchor))``: the first factor is summed per era while
    rows are pre-aggregated, the second is applied to the few sums. Eras are as long as the first factor
    stays harmless; at 0.001 per day one era lasts 137 years.
    """

    def __init__(self, per_day: float):
        if per_day < 0:
            raise ValueError("decay must not be negative")
        self.per_day = per_day
        self.era_seconds = int(_MAX_EXPONENT / per_day * SECONDS_PER_DAY) if per_day > 0 else None

    def era(self, seconds: Column) -> Column:
        if self.era_seconds is None:
            return F.lit(0).cast("long")
        return F.floor(seconds / F.lit(self.era_seconds)).cast("long")

    def within_era(self, seconds: Column) -> Column:
        return F.exp(F.lit(self.per_day) * self._days_from_anchor(seconds, self.era(seconds)))

    def from_era(self, era: Column, latest: Column) -> Column:
        return F.exp(F.lit(-self.per_day) * self._days_from_anchor(latest, era))

    def _days_from_anchor(self, seconds: Column, era: Column) -> Column:
        return (seconds - era * F.lit(self.era_seconds or 0)) / F.lit(SECONDS_PER_DAY)
