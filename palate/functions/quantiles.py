"""Exact order statistics without sorting or collecting a whole column."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.functions.expressions import epoch
from palate.functions.local import COUNT, NUMBER, TEXT, local_frame


def time_quantiles(events: DataFrame, probabilities: Sequence[float], column: str = "timestamp") -> DataFrame:
    """Smallest time at or below which at least ``p`` of the rows lie, for each ``p``.

    One pass for the count and the ends, then :func:`order_statistics` narrows an interval of seconds per
    probability. No task sees more than the slots of one interval, whatever the unit or spread of the times.

    Returns ``(position, epoch, row_count, min_epoch, max_epoch)``, one row per probability, none if
    there are no events.
    """
    seconds = events.select(epoch(column).alias("epoch")).where(F.col("epoch").isNotNull())
    n, lo, hi = seconds.agg(F.count(F.lit(1)), F.min("epoch"), F.max("epoch")).first()
    ranks = [max(math.ceil(p * n), 1) for p in probabilities]
    # Seconds are far below 2**53, so doubles hold them exactly.
    counts = seconds.select(F.lit("all").alias("key"), F.col("epoch").cast("double").alias("value"), F.lit(1).alias("n"))
    found = order_statistics(counts, {"all": ranks}, {"all": (float(lo), float(hi))})["all"] if n else {}
    rows = [(i, int(found[rank]), n, lo, hi) for i, rank in enumerate(ranks)] if n else []
    columns = dict.fromkeys(("position", "epoch", "row_count", "min_epoch", "max_epoch"), COUNT)
    return local_frame(events.sparkSession, columns, rows)


_CELL = {"key": TEXT, "lo": NUMBER, "hi": NUMBER, "pending": pa.list_(pa.struct({"rank": COUNT, "left": COUNT}))}


def _close_finished(cells: list[tuple], found: dict[str, dict[int, float]]) -> list[tuple]:
    """Note the ranks of cells that hold a single value; return the others."""
    for key, lo, hi, pending in cells:
        if lo == hi:
            found[key].update({entry["rank"]: lo for entry in pending})
    return [cell for cell in cells if cell[1] != cell[2]]


def order_statistics(
    counts: DataFrame,
    ranks: Mapping[str, Iterable[int]],
    bounds: Mapping[str, tuple[float, float]],
    fan_out: int = 4096,
) -> dict[str, dict[int, float]]:
    """The values at the given 1-based ranks of each key's sorted values.

    ``counts`` holds ``(key, value, n)``: ``value`` occurs ``n`` times. Each pass cuts every interval that
    still contains a wanted rank into ``fan_out`` equal slots, counts the slots, and keeps the slots the
    ranks fall in, narrowed to their smallest and largest actual value. An interval is finished when both
    agree. The ends of an interval always fall in different slots, so every pass makes progress, and the
    result is exact whatever the distribution. Only the surviving intervals, at most one per rank, reach
    the driver.
    """
    found: dict[str, dict[int, float]] = {key: {} for key in ranks}
    open_cells = []
    for key, wanted in ranks.items():
        lo, hi = bounds[key]
        if not math.isfinite(hi - lo):
            raise ValueError(f"values of {key} must span a finite range")
        pending = [{"rank": rank, "left": rank} for rank in sorted(set(wanted))]
        open_cells.append((key, lo, hi, pending))
    open_cells = _close_finished(open_cells, found)

    while open_cells:
        cells = local_frame(counts.sparkSession, _CELL, open_cells)
        slot = F.least(
            F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(fan_out)),
            F.lit(fan_out - 1),
        )
        # Cells of a key are disjoint, so each value meets at most one of them.
        slots = (
            counts.join(F.broadcast(cells.select("key", "lo", "hi")), "key")
            .where(F.col("value").between(F.col("lo"), F.col("hi")))
            .groupBy("key", "lo", slot.alias("slot"))
            .agg(F.sum("n").alias("n"), F.min("value").alias("slot_lo"), F.max("value").alias("slot_hi"))
            .withColumn("through", F.sum("n").over(Window.partitionBy("key", "lo").orderBy("slot")))
        )
        before = F.col("through") - F.col("n")
        hits = (
            slots.join(F.broadcast(cells.select("key", "lo", "pending")), ["key", "lo"])
            .select(
                "key",
                "slot_lo",
                "slot_hi",
                F.transform(
                    F.filter("pending", lambda r: (r["left"] > before) & (r["left"] <= F.col("through"))),
                    lambda r: F.struct(r["rank"].alias("rank"), (r["left"] - before).alias("left")),
                ).alias("pending"),
            )
            .where(F.size("pending") > 0)
            .collect()
        )
        open_cells = _close_finished(
            [(h.key, h.slot_lo, h.slot_hi, [r.asDict() for r in h.pending]) for h in hits], found
        )
    return found


@dataclass(frozen=True)
class ValueRange:
    """How many values a key has, and their ends."""

    n: int
    lo: float
    hi: float


def interpolated_quantiles(
    counts: DataFrame, ranges: Mapping[str, ValueRange], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles per key of ``counts(key, value, n)``, exact like a full sort."""
    positions = {key: [(r.n - 1) * p for p in probabilities] for key, r in ranges.items()}
    ranks = {
        key: {rank for at in places for rank in (math.floor(at) + 1, min(math.floor(at) + 2, ranges[key].n))}
        for key, places in positions.items()
    }
    values = order_statistics(counts, ranks, {key: (r.lo, r.hi) for key, r in ranges.items()})

    def interpolate(key: str, at: float) -> float:
        base = math.floor(at)
        low, high = values[key][base + 1], values[key][min(base + 2, ranges[key].n)]
        part = at - base
        # Measured from the nearer end, which keeps equal neighbours exactly equal.
        return low + (high - low) * part if part < 0.5 else high - (high - low) * (1 - part)

    return {key: [interpolate(key, at) for at in places] for key, places in positions.items()}
