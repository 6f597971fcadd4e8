"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from palate import schemas, settings
from palate.checks.testbed import EVENT_TYPES, GENRES, KEPT, Testbed, wall_clock_seconds
from palate.functions.local import COUNT, TEXT, local_frame
from palate.operators import (
    diff,
    drift,
    features,
    labels,
    matrix,
    metrics,
    model,
    quality,
    ranking,
    silver,
    temporal,
    validation,
)
from palate.plans import bootstrap, incremental, serving
from palate.plans.training import fit_and_evaluate, read_split_boundaries, train_variant, validate
from palate.settings import BoostingParams, Variant
from palate.sources import csv
from palate.sources.scratch import new_dir, stage
from palate.sources.tables import TableStore
from palate.streaming import arrivals, replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Slice limits that fill all three slices at the small test scales, where no user reaches 200 ratings.
LOW, HIGH = 30, 45
SESSION_GAP = 4 * 3600
TREES = BoostingParams(trees=5, learning_rate=0.1, leaves=31)
ONE_SPLIT = BoostingParams(trees=1, learning_rate=0.1, leaves=2)
ONE_LEAF = BoostingParams(trees=1, learning_rate=0.1, leaves=1)


def tidy(df: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Doubles to six decimals and times to whole seconds, but for the columns ``kept``, so that engines can be compared by value.

    The 1e-9 keeps the order of a sum from deciding how an exact tie is rounded. Plain arithmetic, because
    ``round`` on doubles goes through decimal text and would dominate the run time.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in kept:
            pass
        elif isinstance(field.dataType, DoubleType):
            column = F.rint((column + F.lit(1e-9)) * F.lit(1e6)) / F.lit(1e6)
        elif isinstance(field.dataType, TimestampType):
            column = F.unix_seconds(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(build: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(build(Testbed(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# --- landing and bronze ---------------------------------------------------------------------------


def _landing(bed: Testbed) -> str:
    landing = new_dir(bed.spark, "landing")
    for table, filename in settings.BRONZE_FILES.items():
        df: DataFrame = getattr(bed, table)
        df.write.option("header", True).option("escape", '"').csv(f"{landing}/{filename}")
    return landing


def _store(bed: Testbed) -> TableStore:
    return TableStore(bed.spark, new_dir(bed.spark, "store"))


@query
def ingest_csv(bed: Testbed) -> DataFrame:
    path = new_dir(bed.spark, "landing")
    bed.ratings.write.option("header", True).csv(path)
    return csv.ingest_csv(_store(bed), path, "bronze.ratings", schemas.BRONZE["ratings"])


@query
def ingest_all(bed: Testbed) -> DataFrame:
    return quality.table_counts(csv.ingest_all(_store(bed), _landing(bed)))


@query
def ingest_missing(bed: Testbed) -> DataFrame:
    store, landing = _store(bed), _landing(bed)
    csv.ingest_all(store, landing, {t: settings.BRONZE_FILES[t] for t in ("ratings", "links")})
    outcome = csv.ingest_missing(store, landing)
    counts = quality.table_counts({t: store.read(f"bronze.{t}") for t in outcome})
    skipped = [t for t, what in outcome.items() if what == "skipped"]
    return counts.withColumn("outcome", F.when(F.col("table_name").isin(*skipped), "skipped").otherwise("loaded"))


@query
def links_text_keys(bed: Testbed) -> DataFrame:
    path = new_dir(bed.spark, "landing")
    bed.links.write.option("header", True).csv(path)
    return csv.ingest_csv(_store(bed), path, "bronze.links", schemas.BRONZE["links"])


# --- silver ---------------------------------------------------------------------------------------


@query
def clean_ratings(bed: Testbed) -> DataFrame:
    return bed.clean_once


@query
def explode_genres(bed: Testbed) -> DataFrame:
    return bed.exploded


@query
def variant_filter(bed: Testbed) -> DataFrame:
    return bed.exploded_kept


@query
def genome_agg(bed: Testbed) -> DataFrame:
    return bed.genome


def _sided(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    return first.withColumn("side", F.lit(names[0])).unionAll(second.withColumn("side", F.lit(names[1])))


@query
def holdout_split(bed: Testbed) -> DataFrame:
    return _sided(*silver.split_holdout(bed.clean), ("training", "holdout"))


@query
def advance_window(bed: Testbed) -> DataFrame:
    _, holdout = silver.split_holdout(bed.clean)
    return _sided(*replay.advance_window(holdout), ("moved", "remaining"))


@query
def replay_store(bed: Testbed) -> DataFrame:
    store = _store(bed)
    training, holdout = silver.split_holdout(bed.clean)
    store.overwrite(settings.RATINGS_HOLDOUT, holdout)
    store.overwrite_sliced(settings.RATINGS_CLEAN, training)
    replay.advance(store, days=30)
    replay.advance(store, days=1)
    return _sided(store.read(settings.RATINGS_CLEAN), replay.remaining_holdout(store), ("clean", "holdout"))


# --- gold -----------------------------------------------------------------------------------------


@query
def sample_users(bed: Testbed) -> DataFrame:
    return features.sample_users(bed.clean_once, settings.SAMPLE_FRACTION_DEV)


@query
def sample_tags(bed: Testbed) -> DataFrame:
    return features.sample_users(bed.tags, settings.SAMPLE_FRACTION_DEV)


@query
def user_genre_features(bed: Testbed) -> DataFrame:
    return features.user_genre_features(bed.clean_once, bed.exploded, bed.genome, bed.tags)


@query
def user_profile_features(bed: Testbed) -> DataFrame:
    return features.user_profile_features(bed.listed)


@query
def split_boundaries(bed: Testbed) -> DataFrame:
    return bed.boundaries.drop("computed_at")


@query
def upsert_features(bed: Testbed) -> DataFrame:
    store, clean = _store(bed), bed.clean
    training, _ = silver.split_holdout(clean)
    sampled = features.sample_users(clean, settings.SAMPLE_FRACTION_DEV)
    for ratings in (training, sampled):
        store.upsert(settings.USER_PROFILE_FEATURES, features.user_profile_features(ratings, bed.exploded), ["userId"])
    return store.read(settings.USER_PROFILE_FEATURES)


def _built(bed: Testbed, fraction: float) -> TableStore:
    store = _store(bed)
    for table in ("ratings", "movies", "tags", "genome_scores", "genome_tags"):
        store.overwrite(f"bronze.{table}", getattr(bed, table))
    bootstrap.build_silver(store)
    bootstrap.build_features(store, fraction)
    return store


@query
def built_user_genre(bed: Testbed) -> DataFrame:
    return _built(bed, settings.SAMPLE_FRACTION_DEV).read(settings.USER_GENRE_FEATURES)


@query
def built_user_genre_full(bed: Testbed) -> DataFrame:
    return _built(bed, 1.0).read(settings.USER_GENRE_FEATURES)


@query
def built_profiles(bed: Testbed) -> DataFrame:
    return _built(bed, 1.0).read(settings.USER_PROFILE_FEATURES)


@query
def built_boundaries(bed: Testbed) -> DataFrame:
    store = _store(bed)
    store.overwrite(settings.RATINGS_CLEAN, silver.split_holdout(bed.clean)[0])
    bootstrap.build_boundaries(store)
    train, holdout = read_split_boundaries(store)
    columns = {"train_boundary_ts": COUNT, "holdout_boundary_ts": COUNT}
    return local_frame(bed.spark, columns, [(train, holdout)])


# --- labels ---------------------------------------------------------------------------------------


@query
def training_labels(bed: Testbed) -> DataFrame:
    return bed.labels


@query
def training_labels_nokids(bed: Testbed) -> DataFrame:
    return bed.labels_for(bed.exploded_kept)


@query
def feature_user_labels(bed: Testbed) -> DataFrame:
    sampled = features.sample_users(bed.clean, settings.SAMPLE_FRACTION_DEV)
    profiles = features.user_profile_features(sampled, bed.exploded)
    return labels.train_val_only(labels.restrict_to_feature_users(bed.labels, profiles))


@query
def training_set(bed: Testbed) -> DataFrame:
    return bed.training_cells


@query
def holdout_cells(bed: Testbed) -> DataFrame:
    cells = labels.holdout_cells(bed.clean, bed.exploded, bed.boundary("holdout_boundary_ts"))
    return labels.restrict_to_feature_users(cells, bed.known_users)


@query
def holdout_metadata(bed: Testbed) -> DataFrame:
    return labels.holdout_metadata(bed.clean, bed.exploded, bed.known_users, bed.boundary("holdout_boundary_ts"))


# --- wide matrices --------------------------------------------------------------------------------


@query
def pivot_labels(bed: Testbed) -> DataFrame:
    return matrix.pivot_labels(bed.labels.where(F.col("split_flag") == "train"), GENRES)


@query
def pivot_features(bed: Testbed) -> DataFrame:
    return matrix.pivot_features(bed.training_cells.where(F.col("split_flag") == "train"), GENRES)


@query
def scoring_matrix(bed: Testbed) -> DataFrame:
    return model.scoring_matrix(bed.user_genre, bed.profiles, KEPT)


# --- evaluation -----------------------------------------------------------------------------------
# Two plain predictors stand in for models: the user's mean rating challenges the genre's training mean.


def _predictions(bed: Testbed, genres: tuple[str, ...], exploded: DataFrame) -> DataFrame:
    held_out = labels.holdout_cells(bed.clean, exploded, bed.boundary("holdout_boundary_ts"))
    truth = matrix.dense_cells(labels.restrict_to_feature_users(held_out, bed.known_users), genres)
    trained = bed.labels_for(exploded).where(F.col("split_flag") == "train")
    champion = trained.groupBy("genre").agg(F.avg("label").alias("champion"))
    challenger = bed.clean.groupBy("userId").agg(F.avg("rating").alias("p"))
    return truth.join(challenger, "userId", "left").join(champion, "genre", "left")


def _cells(bed: Testbed) -> DataFrame:
    return _predictions(bed, GENRES, bed.exploded)


@query
def prediction_cells(bed: Testbed) -> DataFrame:
    return _cells(bed)


@query
def metrics_overall(bed: Testbed) -> DataFrame:
    return metrics.metrics_overall(_cells(bed))


@query
def metrics_per_genre(bed: Testbed) -> DataFrame:
    return metrics.metrics_per_genre(_cells(bed))


@query
def champion_check(bed: Testbed) -> DataFrame:
    return metrics.compare_champion(_cells(bed))


@query
def champion_check_gaps(bed: Testbed) -> DataFrame:
    known = F.when(F.col("genre") != GENRES[0], F.col("champion"))
    return metrics.compare_champion(_cells(bed).withColumn("champion", known))


@query
def smoke_test(bed: Testbed) -> DataFrame:
    return metrics.smoke_test(_cells(bed))


@query
def activity_slices(bed: Testbed) -> DataFrame:
    return metrics.activity_slices(_cells(bed), bed.clean, LOW, HIGH)


@query
def activity_slices_default(bed: Testbed) -> DataFrame:
    return metrics.activity_slices(_cells(bed), bed.clean)


def _report(bed: Testbed) -> DataFrame:
    variants = {"general": (GENRES, bed.exploded), "nokids": (KEPT, bed.exploded_kept)}
    cells = [_predictions(bed, *parts).withColumn("variant", F.lit(name)) for name, parts in variants.items()]
    return validation.validation_report(
        metrics.with_activity(reduce(DataFrame.unionByName, cells), bed.clean, LOW, HIGH)
    )


@query
def validation_report(bed: Testbed) -> DataFrame:
    return _report(bed)


@query
def variant_status(bed: Testbed) -> DataFrame:
    return validation.variant_status(_report(bed))


@query
def promotion_gate(bed: Testbed) -> DataFrame:
    return validation.promotion_gate(_report(bed), ["general", "nokids"])


# --- time -----------------------------------------------------------------------------------------


@query
def training_set_asof(bed: Testbed) -> DataFrame:
    return temporal.training_set_asof(bed.clean, bed.exploded, bed.boundary("train_boundary_ts"))


@query
def ratings_in_versions(bed: Testbed) -> DataFrame:
    """Every rating with the version of its user's features that was valid then."""
    points = silver.per_genre(bed.listed, None).select("userId", "genre", "movieId", F.unix_seconds("timestamp").alias("rated_at"))
    tasks = temporal.tasks_by_key(bed.listed)
    versions = stage(temporal.feature_history(bed.listed, tasks=tasks).drop("last_rated"), "versions")
    keys = ["userId", "genre"]
    return temporal.interval_join(points, versions, keys, "rated_at", "valid_from", "valid_until", tasks=tasks)


@query
def moving_means(bed: Testbed) -> DataFrame:
    return temporal.moving_means(bed.clean)


@query
def event_sessions(bed: Testbed) -> DataFrame:
    events = bed.table("events").withColumn("at", wall_clock_seconds("ts"))
    return temporal.sessions(events, "user_id", "at", gap=SESSION_GAP)


# --- incremental features -------------------------------------------------------------------------


def _replayed(bed: Testbed) -> TableStore:
    """A store whose features were first built and then brought up to date by three windows."""
    store = _store(bed)
    for table in ("ratings", "movies", "tags", "genome_scores", "genome_tags"):
        store.overwrite(f"bronze.{table}", getattr(bed, table))
    bootstrap.build_silver(store)
    incremental.rebuild(store)
    incremental.simulate_day(store, days=30)
    incremental.simulate_day(store, days=30)
    incremental.compact(store)
    incremental.simulate_day(store, days=30)
    return store


@query
def incremental_features(bed: Testbed) -> DataFrame:
    return _replayed(bed).read(settings.USER_GENRE_FEATURES)


@query
def incremental_profiles(bed: Testbed) -> DataFrame:
    return _replayed(bed).read(settings.USER_PROFILE_FEATURES)


# --- arrivals -------------------------------------------------------------------------------------


def _arrived(bed: Testbed) -> TableStore:
    """All ratings as files of four arrivals: late ones among them, and a part of them twice; the stream is started anew each time."""
    store, landing, checkpoint = _store(bed), new_dir(bed.spark, "arrivals"), new_dir(bed.spark, "stream")
    ratings = stage(bed.ratings, "arriving")
    quarter = F.pmod(F.xxhash64("userId", "movieId", "timestamp"), F.lit(4))
    parts = [ratings.where(quarter == number) for number in (3, 2)]
    parts += [ratings.where(quarter.isin(1, 2)), ratings.where(quarter == 0)]
    for part in parts:
        part.write.mode("append").parquet(landing)
        arrivals.take_up(store, landing, checkpoint, files_per_batch=3)
    return store


@query
def arrived_clean(bed: Testbed) -> DataFrame:
    return arrivals.settled(_arrived(bed))


# --- order ----------------------------------------------------------------------------------------


def _scores(bed: Testbed) -> DataFrame:
    return stage(tidy(bed.user_genre.select("userId", "genre", F.col("genre_avg_rating").alias("score"))), "scores")


@query
def score_ranks(bed: Testbed) -> DataFrame:
    return ranking.global_ranks(_scores(bed), "score")


@query
def score_leaders(bed: Testbed) -> DataFrame:
    return ranking.leaders(_scores(bed), "score", 100)


@query
def best_genres(bed: Testbed) -> DataFrame:
    return ranking.best_of_group(_scores(bed), "userId", "score", 3)


# --- drift ----------------------------------------------------------------------------------------


def _feature_versions(bed: Testbed) -> tuple[DataFrame, DataFrame]:
    """Features of the training part, and of that plus the next 150 days."""
    training, holdout = silver.split_holdout(bed.described)
    arrived, _ = replay.advance_window(holdout, days=150)
    # The later version adds the sums of the days between to those of the earlier.
    before = stage(features.genre_sums(training), "sums-before")
    both = before.unionByName(features.genre_sums(arrived))
    tagged = stage(features.tag_counts(bed.tags, bed.exploded), "tag-counts")
    return features.genre_features(before, tagged), features.genre_features(both, tagged)


# An index moves in steps of one row in a bin. The last bits of a feature, which depend on the order of its sum, can
# move a row that lies on an edge, so results, not features, are rounded before engines are compared.


def _three_decimals(report: DataFrame) -> DataFrame:
    return report.withColumn("psi", F.round(F.col("psi") + F.lit(1e-9), 3))


def _three_decimals_of_log() -> Column:
    parsed = F.from_json("feature_psi", "map<string, decimal(18,6)>")
    return F.to_json(F.transform_values(parsed, lambda _, psi: (psi + F.lit(1e-9)).cast("decimal(18,3)")))


@query
def feature_diff(bed: Testbed) -> DataFrame:
    """What the next 150 days change in the features, to six decimals."""
    before, after = (tidy(version) for version in _feature_versions(bed))
    changes = diff.table_diff(before, after, ["userId", "genre"])
    return changes.withColumn("changed_columns", F.array_join("changed_columns", ","))


@query
def psi_by_feature(bed: Testbed) -> DataFrame:
    return _three_decimals(drift.drift_report(*_feature_versions(bed)))


@query
def drift_log(bed: Testbed) -> DataFrame:
    return drift.drift_summary(_three_decimals(drift.drift_report(*_feature_versions(bed)))).withColumn(
        "feature_psi", _three_decimals_of_log()
    )


@query
def drift_check(bed: Testbed) -> DataFrame:
    store = _store(bed)
    for version in _feature_versions(bed):
        store.overwrite(settings.USER_GENRE_FEATURES, version)
        log = serving.drift_check(store, "checks")
    return log.drop("timestamp").withColumn("feature_psi", _three_decimals_of_log())


@query
def psi_by_event_type(bed: Testbed) -> DataFrame:
    earlier, later = silver.split_holdout(bed.events, 0.5)
    return drift.psi(earlier, later, EVENT_TYPES)


# --- models ---------------------------------------------------------------------------------------


@query
def fit_multi_output(bed: Testbed) -> DataFrame:
    _, per_genre, _ = fit_and_evaluate(bed.training_cells, GENRES, TREES)
    return per_genre


@query
def batch_score(bed: Testbed) -> DataFrame:
    bed.stage_features()
    train = bed.training_cells_kept.where(F.col("split_flag") == "train")
    fitted = model.fit_rows(matrix.pivot_training(train, KEPT), KEPT, settings.BOOSTING_DEV)
    return model.batch_score(bed.user_genre, bed.profiles, fitted)


# A model of single leaves predicts the mean label, which SQL can check to the last digit.


@query
def mean_model_metrics(bed: Testbed) -> DataFrame:
    _, per_genre, _ = fit_and_evaluate(bed.training_cells, GENRES, ONE_LEAF)
    return per_genre


@query
def mean_model_scores(bed: Testbed) -> DataFrame:
    bed.stage_features()
    fitted, _, _ = fit_and_evaluate(bed.training_cells, GENRES, ONE_LEAF)
    return model.batch_score(bed.user_genre, bed.profiles, fitted)


@query
def boosted_split(bed: Testbed) -> DataFrame:
    """The first split of every genre, on features to six decimals, so that engines see the same ties."""
    train = matrix.pivot_training(bed.training_cells.where(F.col("split_flag") == "train"), GENRES)
    fitted = model.fit_rows(tidy(train, kept=matrix.target_columns(GENRES)), GENRES, ONE_SPLIT)
    gains = fitted.leaves(bed.spark).select("genre", "node", "value")
    low, high = (gains.select("genre", F.col("node").alias(n), F.col("value").alias(f"{n}_gain")) for n in ("low", "high"))
    found = fitted.splits(bed.spark).join(low, ["genre", "low"]).join(high, ["genre", "high"])
    return found.select("genre", "feature", "threshold", "low_gain", "high_gain")


def _trained(bed: Testbed) -> tuple[TableStore, dict[Variant, model.MultiOutputModel]]:
    """A store from bronze to gold, and both variants' models of single leaves."""
    store = _built(bed, 1.0)
    store.overwrite(settings.MOVIES_EXPLODED_NOKIDS, bed.exploded_kept)
    variants = (
        Variant("general", GENRES, settings.MOVIES_EXPLODED, settings.SCORES_DAILY),
        Variant("nokids", KEPT, settings.MOVIES_EXPLODED_NOKIDS, settings.SCORES_DAILY_NOKIDS),
    )
    return store, {variant: train_variant(store, variant, ONE_LEAF)[0] for variant in variants}


@query
def trained_metrics(bed: Testbed) -> DataFrame:
    store, models = _trained(bed)
    stored = [
        store.read(f"{settings.TRAINING_METRICS}_{v.name}").withColumn("variant", F.lit(v.name)) for v in models
    ]
    return reduce(DataFrame.unionByName, stored)


@query
def validated_store(bed: Testbed) -> DataFrame:
    store, models = _trained(bed)
    general, nokids = models
    return validate(store, {general: (models[general], models[general]), nokids: (models[nokids], None)})


@query
def table_problems(bed: Testbed) -> DataFrame:
    tables = {
        "bronze.ratings": bed.ratings,
        "bronze.links": bed.links,
        "bronze.nothing": bed.links.where("movieId IS NULL"),
        "silver.ratings_clean": bed.clean,
    }
    required = {"bronze.ratings": ["userId", "movieId"], "bronze.links": ["imdbId", "title"]}
    found = quality.table_problems(tables, required)
    return local_frame(bed.spark, {"table_name": TEXT, "problem": TEXT}, sorted(found.items()))


@query
def table_counts(bed: Testbed) -> DataFrame:
    return quality.table_counts(
        {
            settings.RATINGS_CLEAN: bed.clean,
            settings.MOVIES_EXPLODED: bed.exploded,
            settings.MOVIES_EXPLODED_NOKIDS: bed.exploded_kept,
            settings.GENOME_AGG: bed.genome,
            settings.USER_GENRE_FEATURES: bed.user_genre,
            settings.USER_PROFILE_FEATURES: bed.profiles,
        }
    )
