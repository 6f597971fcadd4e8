"""The model's input tables, derived from the star-schema test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate import settings
from palate.operators import features, labels, silver
from palate.sources.scratch import stage

# The words that make up part names, used as genres, the excluded ones, and the event types.
ADJECTIVES = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
NOUNS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
GENRES = tuple(sorted(ADJECTIVES + NOUNS))
EXCLUDED = ("cold", "old", "rod")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
KEPT = tuple(g for g in GENRES if g not in EXCLUDED)

# Rows of the largest table that one task joins and sorts.
ROWS_OF_A_TASK = 500_000

# The columns used of each test table. Given to the reader, so that no job infers them.
COLUMNS = {
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_discount DOUBLE,"
    " l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}


def wall_clock_seconds(column: str):
    """Seconds since 1970 of a timestamp without time zone, whatever the session time zone."""
    since_epoch = f"{column} - TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return F.expr(f"CAST(CAST({since_epoch} AS INTERVAL SECOND) AS BIGINT)")


class Testbed:
    """Lazily defined frames; nothing runs until a query does."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self._dir}/{name}.parquet")

    @cached_property
    def _purchases(self) -> DataFrame:
        # What ratings need of an item is worked out before items are shuffled.
        lines, orders = self.table("lineitem"), self.table("orders")
        stars = (F.col("l_quantity").cast("long") % 10 + 1) * F.lit(0.5)
        items = lines.select(
            "l_orderkey",
            "l_returnflag",
            F.col("l_partkey").alias("movieId"),
            F.when(F.col("l_discount") != 0.0, stars).alias("rating"),
            wall_clock_seconds("l_shipdate").alias("timestamp"),
        )
        tasks = -(-lines.count() // ROWS_OF_A_TASK)
        if tasks > self.spark.sparkContext.defaultParallelism:
            # Large tables meet in more tasks, so that the memory of one does not grow with them.
            items, orders = items.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
        return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("userId", F.col("o_custkey"))

    @cached_property
    def ratings(self) -> DataFrame:
        return self._purchases.select("userId", "movieId", "rating", "timestamp")

    @cached_property
    def tags(self) -> DataFrame:
        returned = self._purchases.where(F.col("l_returnflag") == "R")
        return returned.select("userId", "movieId", F.col("o_orderpriority").alias("tag"), "timestamp")

    @cached_property
    def movies(self) -> DataFrame:
        words = F.replace("p_name", F.lit(" "), F.lit("|"))
        listed = F.when(F.col("p_size") == 50, settings.NO_GENRES).otherwise(words)
        return self.table("part").select(
            F.col("p_partkey").alias("movieId"), F.col("p_name").alias("title"), listed.alias("genres")
        )

    @cached_property
    def genome_scores(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("movieId"), F.col("l_suppkey").alias("tagId"))
            .agg(F.avg(F.col("l_discount") * 10).alias("relevance"))
        )

    @cached_property
    def genome_tags(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("tagId"), F.col("s_name").alias("tag"))

    @cached_property
    def links(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("movieId"),
            F.lpad(key.cast("string"), 7, "0").alias("imdbId"),
            (key * 2 + 1).alias("tmdbId"),
        )

    @property
    def clean_once(self) -> DataFrame:
        """For queries that read the clean ratings a single time."""
        return silver.clean_ratings(self.ratings)

    @cached_property
    def clean(self) -> DataFrame:
        return stage(self.clean_once, "clean")

    @cached_property
    def exploded(self) -> DataFrame:
        return silver.explode_genres(self.movies)

    @cached_property
    def exploded_kept(self) -> DataFrame:
        return silver.filter_variant(self.exploded, EXCLUDED)

    @cached_property
    def genome(self) -> DataFrame:
        return silver.aggregate_genome(self.genome_scores, self.genome_tags, self.exploded)

    @cached_property
    def listed(self) -> DataFrame:
        """The clean ratings with their genres, for queries that join the two several times."""
        return stage(silver.list_genres(self.clean_once, self.exploded), "listed")

    @cached_property
    def described(self) -> DataFrame:
        """The clean ratings with their genres and the relevance of these, for queries that read features."""
        listed = silver.list_genres(self.clean_once, self.exploded, self.genome)
        return stage(listed.drop("movieId"), "described")

    @cached_property
    def user_genre(self) -> DataFrame:
        sums = features.genre_sums(self.described)
        return features.genre_features(sums, features.tag_counts(self.tags, self.exploded))

    @cached_property
    def profiles(self) -> DataFrame:
        return features.user_profile_features(self.described)

    def stage_features(self) -> None:
        """Write both feature tables down, for queries that read them more than once."""
        self.user_genre, self.profiles = stage(self.user_genre, "user-genre"), stage(self.profiles, "profiles")

    @cached_property
    def known_users(self) -> DataFrame:
        """The profiles, for queries that read no other features."""
        return features.user_profile_features(self.clean, self.exploded)

    @cached_property
    def boundaries(self) -> DataFrame:
        return labels.split_boundaries(self.clean)

    def boundary(self, name: str) -> int:
        return self.boundaries.first()[name]

    @cached_property
    def training_cells(self) -> DataFrame:
        """Labels of both training splits with features."""
        return self._with_features(labels.train_val_only(self._described_labels(self.described)))

    @cached_property
    def training_cells_kept(self) -> DataFrame:
        """Labels of all splits without the excluded genres, with features."""
        return self._with_features(self._described_labels(silver.keep_listed(self.described, EXCLUDED)))

    def _described_labels(self, described: DataFrame) -> DataFrame:
        bounds = labels.split_boundaries(self.described).first()
        return labels.training_labels(described, None, bounds.train_boundary_ts, bounds.holdout_boundary_ts)

    def _with_features(self, cells: DataFrame) -> DataFrame:
        return labels.training_set(cells, self.user_genre, self.profiles)

    @cached_property
    def labels(self) -> DataFrame:
        return self.labels_for(self.exploded)

    def labels_for(self, exploded: DataFrame) -> DataFrame:
        return labels.training_labels(
            self.clean, exploded, self.boundary("train_boundary_ts"), self.boundary("holdout_boundary_ts")
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_type").alias("key"), "value", F.timestamp_seconds(wall_clock_seconds("ts")).alias("timestamp")
        )
