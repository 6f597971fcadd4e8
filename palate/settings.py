"""Names, parameters and thresholds shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass

# Category vocabulary, file names and table names of the data set.
GENRES = (
    "Action",
    "Adventure",
    "Animation",
    "Children",
    "Comedy",
    "Crime",
    "Documentary",
    "Drama",
    "Fantasy",
    "Film-Noir",
    "Horror",
    "Musical",
    "Mystery",
    "Romance",
    "Sci-Fi",
    "Thriller",
    "War",
    "Western",
)
NOKIDS_EXCLUDED = ("Children", "Animation", "Fantasy")
NO_GENRES = "(no genres listed)"
BRONZE_FILES = {
    "ratings": "ratings.csv",
    "movies": "movies.csv",
    "tags": "tags.csv",
    "genome_scores": "genome-scores.csv",
    "genome_tags": "genome-tags.csv",
    "links": "links.csv",
}
RATINGS_CLEAN = "silver.ratings_clean"
RATINGS_HOLDOUT = "silver.ratings_holdout"
RATINGS_ARRIVED = "bronze.ratings_arrived"
ARRIVAL_PROGRESS = "bronze.arrival_progress"
HOLDOUT_PROGRESS = "silver.holdout_progress"
FEATURES_PROGRESS = "gold.features_progress"
MOVIES_EXPLODED = "silver.movies_genre_exploded"
MOVIES_EXPLODED_NOKIDS = "silver.movies_genre_exploded_nokids"
GENOME_AGG = "silver.genome_genre_agg"
USER_GENRE_FEATURES = "gold.user_genre_features"
USER_PROFILE_FEATURES = "gold.user_profile_features"
USER_GENRE_STATE = "gold.user_genre_state"
USER_STATE = "gold.user_state"
USER_TAG_STATE = "gold.user_tag_state"
SPLIT_METADATA = "ml.split_metadata"
VALIDATION_REPORT = "ml.validation_report"
HOLDOUT_METADATA = "ml.holdout_metadata"
GENRE_METRICS = "ml.genre_metrics"
TRAINING_METRICS = "ml.training_metrics"
SCORES_DAILY = "inference.genre_propensity_scores_daily"
SCORES_DAILY_NOKIDS = "inference.genre_propensity_scores_daily_nokids"
FEATURE_BASELINE = "inference.feature_baseline"
MONITORING_LOG = "inference.monitoring_log"

# Feature columns, in table order.
GENRE_FEATURES = (
    "genre_avg_rating",
    "genre_watch_count",
    "genre_recency_score",
    "genre_share",
    "genre_diversity_index",
    "genre_avg_genome_relevance",
    "genre_tag_count",
)
PROFILE_FEATURES = (
    "total_ratings",
    "avg_rating",
    "active_days",
    "distinct_genres",
    "diversity_index",
)

# Parameters and thresholds.
DECAY_PER_DAY = 0.001
HOLDOUT_QUANTILE = 0.8
TRAIN_QUANTILE = 0.6
TEST_QUANTILE = 0.8
RMSE_LIMIT = 1.5
R2_LIMIT = 0.05
GENRE_RMSE_LIMIT = 2.0
SLICE_R2_LIMIT = -0.05
LOW_ACTIVITY = 50
HIGH_ACTIVITY = 200
SAMPLE_SEED = 42
SAMPLE_FRACTION_DEV = 0.2
SAMPLE_FRACTION_PROD = 1.0
REPLAY_DAYS = 30
PSI_LIMIT = 0.2
PSI_BINS = 10
PSI_FLOOR = 1e-6

SECONDS_PER_DAY = 86400


@dataclass(frozen=True)
class Variant:
    """One flavour of everything downstream of silver: which genres are labelled and scored."""

    name: str
    genres: tuple[str, ...]
    exploded_table: str
    scores_table: str


GENERAL = Variant("general", GENRES, MOVIES_EXPLODED, SCORES_DAILY)
NOKIDS = Variant(
    "nokids",
    tuple(g for g in GENRES if g not in NOKIDS_EXCLUDED),
    MOVIES_EXPLODED_NOKIDS,
    SCORES_DAILY_NOKIDS,
)


@dataclass(frozen=True)
class BoostingParams:
    """Boosted-tree settings; ``leaves`` bounds a tree's leaves (1 for the mean alone), ``bins`` a feature's values."""

    trees: int
    learning_rate: float
    leaves: int
    min_rows_per_leaf: int = 20
    bins: int = 64


BOOSTING_DEV = BoostingParams(trees=200, learning_rate=0.1, leaves=31)
BOOSTING_PROD = BoostingParams(trees=500, learning_rate=0.05, leaves=63)
