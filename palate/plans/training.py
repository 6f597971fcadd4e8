"""Training, validation and the decision to promote."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate import settings
from palate.functions.local import NUMBER, TEXT, local_frame
from palate.operators.labels import (
    holdout_cells,
    holdout_metadata,
    train_val_only,
    training_labels,
    training_set,
)
from palate.operators.matrix import melt, pivot_training, prediction_cells, target_columns
from palate.operators.metrics import metrics_overall, metrics_per_genre, with_activity
from palate.operators.model import MultiOutputModel, fit_rows
from palate.operators.validation import promotion_gate, validation_report
from palate.settings import BoostingParams, Variant
from palate.sources.scratch import stage, staged, temporary_stages
from palate.sources.tables import TableStore


def read_split_boundaries(store: TableStore) -> tuple[int, int]:
    """The stored train and holdout boundaries, in seconds."""
    row = store.read(settings.SPLIT_METADATA).first() if store.exists(settings.SPLIT_METADATA) else None
    if row is None:
        raise RuntimeError(f"{settings.SPLIT_METADATA} is missing or empty: build the features first")
    return row.train_boundary_ts, row.holdout_boundary_ts


def fit_and_evaluate(
    cells: DataFrame, genres: tuple[str, ...], params: BoostingParams
) -> tuple[MultiOutputModel, DataFrame, DataFrame]:
    """Fit on the ``train`` cells of a training set; metrics per genre and overall on its ``val`` cells.

    The metrics are a row per genre and one more, and come computed, so that nothing staged outlives the call.
    """
    spark = cells.sparkSession
    with staged(pivot_training(cells, genres, by=["split_flag"]), "training-rows") as rows:
        train, val = (rows.where(F.col("split_flag") == flag) for flag in ("train", "val"))
        model = fit_rows(train, genres, params)
        scores = model.predict(val, kept=target_columns(genres))
        with staged(melt(scores, genres, y="target_", p=""), "validation-cells") as predicted:
            per_genre, overall = metrics_per_genre(predicted).collect(), metrics_overall(predicted).collect()
    return (
        model,
        local_frame(spark, {"genre": TEXT, "rmse": NUMBER}, per_genre),
        local_frame(spark, {"rmse_overall": NUMBER, "r2_overall": NUMBER}, overall),
    )


def train_variant(
    store: TableStore, variant: Variant, params: BoostingParams
) -> tuple[MultiOutputModel, DataFrame, DataFrame]:
    """Model of a variant, with its metrics per genre and overall on the validation split, which are stored too."""
    labels = training_labels(
        store.read(settings.RATINGS_CLEAN), store.read(variant.exploded_table), *read_split_boundaries(store)
    )
    # A training set needs a profile, so it is already restricted to users that have features.
    cells = training_set(
        train_val_only(labels),
        store.read(settings.USER_GENRE_FEATURES),
        store.read(settings.USER_PROFILE_FEATURES),
    )
    nothing = F.lit(None)
    with temporary_stages(store.spark):
        model, per_genre, overall = fit_and_evaluate(cells, variant.genres, params)
        whole = overall.select(nothing.cast("string").alias("genre"), "rmse_overall", "r2_overall").toDF("genre", "rmse", "r2")
        errors = per_genre.select("genre", "rmse", nothing.cast("double").alias("r2")).unionByName(whole)
        stored = store.overwrite(f"{settings.TRAINING_METRICS}_{variant.name}", errors)
    whole = stored.where("genre IS NULL").select("rmse", "r2").toDF("rmse_overall", "r2_overall")
    return model, stored.where("genre IS NOT NULL").select("genre", "rmse"), whole


def evaluation_cells(
    store: TableStore, variant: Variant, challenger: MultiOutputModel, champion: MultiOutputModel | None
) -> DataFrame:
    """Predictions of challenger and champion on the same test cells, with the user's activity slice."""
    ratings = store.read(settings.RATINGS_CLEAN)
    labels = holdout_cells(ratings, store.read(variant.exploded_table), read_split_boundaries(store)[1])
    cells = training_set(
        labels, store.read(settings.USER_GENRE_FEATURES), store.read(settings.USER_PROFILE_FEATURES)
    )
    # One matrix for both models; each adds its scores in a pass over what is written.
    matrix = stage(pivot_training(cells, variant.genres), "test-matrix")
    targets = target_columns(variant.genres)
    scores = challenger.predict(matrix, kept=targets)
    if champion is None:
        predicted = melt(scores, variant.genres, y="target_", p="").withColumn("champion", F.lit(None).cast("double"))
    else:
        truth = scores.select("userId", *[F.col(f"`target_{g}`").alias(g) for g in variant.genres])
        predicted = prediction_cells(truth, variant.genres, p=scores, champion=champion.predict(matrix))
    return with_activity(predicted, ratings).withColumn("variant", F.lit(variant.name))


def validate(
    store: TableStore,
    candidates: Mapping[Variant, tuple[MultiOutputModel, MultiOutputModel | None]],
) -> DataFrame:
    """Report on every variant's challenger against its champion, stored and returned.

    Stored beside it: each genre's error, and what was held out.
    """
    with temporary_stages(store.spark):
        cells = [evaluation_cells(store, variant, *models) for variant, models in candidates.items()]
        rows = stage(reduce(DataFrame.unionByName, cells), "evaluation-cells")
        per_genre = [
            metrics_per_genre(rows.where(F.col("variant") == v.name)).withColumn("variant", F.lit(v.name))
            for v in candidates
        ]
        store.overwrite(settings.GENRE_METRICS, reduce(DataFrame.unionByName, per_genre))
        ratings, profiles = store.read(settings.RATINGS_CLEAN), store.read(settings.USER_PROFILE_FEATURES)
        boundary = read_split_boundaries(store)[1]
        held_out = [
            holdout_metadata(ratings, store.read(v.exploded_table), profiles, boundary).withColumn(
                "variant", F.lit(v.name)
            )
            for v in candidates
        ]
        store.overwrite(settings.HOLDOUT_METADATA, reduce(DataFrame.unionByName, held_out))
        return store.overwrite(settings.VALIDATION_REPORT, validation_report(rows))


def require_promotion(report: DataFrame, variants: tuple[str, ...] = ("general", "nokids")) -> None:
    """Stop the run unless every variant has passed."""
    if not promotion_gate(report, variants).first().promoted:
        raise RuntimeError("a variant failed validation: nothing is promoted and nothing is scored")
