"""Daily work: score every user, watch for drift, let new ratings arrive."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate import settings
from palate.operators.drift import drift_report, drift_summary
from palate.operators.model import MultiOutputModel, batch_score
from palate.plans.bootstrap import build_user_features
from palate.settings import Variant
from palate.sources.tables import TableStore
from palate.streaming.replay import NO_HOLDOUT_DATA, advance, moved_through


def score_variant(store: TableStore, variant: Variant, model: MultiOutputModel) -> int:
    """Replace the variant's scores; returns how many users were scored."""
    scores = batch_score(
        store.read(settings.USER_GENRE_FEATURES), store.read(settings.USER_PROFILE_FEATURES), model
    )
    # Counted on what was written: parquet answers that from its footers.
    return store.overwrite(variant.scores_table, scores).count()


def drift_check(store: TableStore, catalog: str) -> DataFrame:
    """Log one row on how far the features have moved; the first run stores them as the baseline instead."""
    current = store.read(settings.USER_GENRE_FEATURES)
    if store.exists(settings.FEATURE_BASELINE):
        report = drift_report(store.read(settings.FEATURE_BASELINE), current)
    else:
        store.overwrite(settings.FEATURE_BASELINE, current)
        report = store.spark.createDataFrame([], "feature STRING, psi DOUBLE, drifted BOOLEAN")
    moment = datetime.now(UTC).replace(tzinfo=None).isoformat()
    row = drift_summary(report).select(
        F.lit(moment).alias("timestamp"),
        F.lit(catalog).alias("catalog"),
        "feature_psi",
        "prediction_psi",
        "drift_detected",
    )
    return store.append(settings.MONITORING_LOG, row)


def simulate_day(store: TableStore, days: int = settings.REPLAY_DAYS, fraction: float = 1.0) -> int | str:
    """Let the next window of held-out ratings arrive and refresh the features; returns the window's end.

    How far features reach is stored after they are built. Where they lag behind, an earlier call broke off
    between its two steps; this call then finishes that one instead of moving a further window.
    """
    moved = moved_through(store)
    if moved is None or moved == _features_through(store):
        moved = advance(store, days)
    if moved != NO_HOLDOUT_DATA:
        build_user_features(store, fraction)
        reached = store.spark.createDataFrame([(moved,)], "features_through BIGINT")
        store.overwrite(settings.FEATURES_PROGRESS, reached)
    return moved


def _features_through(store: TableStore) -> int | None:
    row = store.read(settings.FEATURES_PROGRESS).first() if store.exists(settings.FEATURES_PROGRESS) else None
    return None if row is None else row.features_through
