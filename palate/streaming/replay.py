"""Replaying held-out ratings as if they arrived day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate import settings
from palate.functions.expressions import after, at_or_before, epoch
from palate.sources.tables import TableStore

NO_HOLDOUT_DATA = "NO_HOLDOUT_DATA"


def window_end(holdout: DataFrame, days: int) -> int | None:
    """Last second of the next window, counted from the oldest rating held out; none if nothing is."""
    oldest = holdout.agg(F.min(epoch())).first()[0]
    return None if oldest is None else oldest + days * settings.SECONDS_PER_DAY


def advance_window(holdout: DataFrame, days: int = settings.REPLAY_DAYS) -> tuple[DataFrame, DataFrame]:
    """The ratings of the next window (its end included), and what stays held out."""
    until = window_end(holdout, days)
    if until is None:
        return holdout, holdout
    return holdout.where(at_or_before(until)), holdout.where(after(until))


def restart(store: TableStore) -> None:
    """Forget what has been replayed, after the held-out ratings were rebuilt."""
    if store.exists(settings.HOLDOUT_PROGRESS):
        store.overwrite(settings.HOLDOUT_PROGRESS, store.read(settings.HOLDOUT_PROGRESS).limit(0))


def moved_through(store: TableStore) -> int | None:
    """The end of the last window that was moved."""
    progress = store.read(settings.HOLDOUT_PROGRESS).first() if store.exists(settings.HOLDOUT_PROGRESS) else None
    return None if progress is None else progress.moved_through


def remaining_holdout(store: TableStore) -> DataFrame:
    """Ratings that have not been replayed yet."""
    holdout = store.read(settings.RATINGS_HOLDOUT)
    until = moved_through(store)
    return holdout if until is None else holdout.where(after(until))


def advance(store: TableStore, days: int = settings.REPLAY_DAYS) -> int | str:
    """Move the next window into the clean ratings; returns its last second, or a marker when none is left.

    The held-out table is never rewritten: how far it has been consumed is one number, stored last. The
    window is added under its end time, so a run that failed half-way is repaired by running it again.
    """
    holdout = remaining_holdout(store)
    until = window_end(holdout, days)
    if until is None:
        return NO_HOLDOUT_DATA
    store.write_slice(settings.RATINGS_CLEAN, holdout.where(at_or_before(until)), until)
    progress = store.spark.createDataFrame([(until,)], "moved_through BIGINT")
    store.overwrite(settings.HOLDOUT_PROGRESS, progress)
    return until
