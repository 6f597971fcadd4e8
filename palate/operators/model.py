"""One boosted-tree regressor per genre, on shared features and fitted together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.functions.local import COUNT, NUMBER, NUMBERS, TEXT, local_frame
from palate.operators.boosting import UNIT, Ensemble, Tree, fit, predict
from palate.operators.matrix import feature_columns, pivot_features, target_columns
from palate.settings import BoostingParams
from palate.sources.files import write_parquet

_NODES = pa.list_(COUNT)


@dataclass(frozen=True)
class MultiOutputModel:
    """A regressor per genre; ``genres`` fixes the feature columns and the order of the scores."""

    genres: tuple[str, ...]
    ensemble: Ensemble

    def predict(self, matrix: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
        """``userId`` plus one score per genre, in one pass over the feature matrix, and the columns ``kept`` of it."""
        return predict(matrix, "userId", feature_columns(self.genres), self.genres, self.ensemble, kept)

    def splits(self, spark: SparkSession) -> DataFrame:
        """The inner nodes of all trees: ``round, genre, node, feature, threshold, low, high``.

        Values up to the threshold go to node ``low``, others to ``high``.
        """
        columns = feature_columns(self.genres)
        kinds = {"round": COUNT, "genre": TEXT, "node": COUNT, "feature": TEXT, "threshold": NUMBER}
        rows = [
            (number, genre, node, columns[feature], self.ensemble.cuts[feature][tree.bin[node]], left, left + 1)
            for number, grown in enumerate(self.ensemble.trees)
            for genre, tree in zip(self.genres, grown, strict=True)
            for node, (feature, left) in enumerate(zip(tree.feature, tree.left, strict=True))
            if feature >= 0
        ]
        return local_frame(spark, kinds | {"low": COUNT, "high": COUNT}, rows)

    def leaves(self, spark: SparkSession) -> DataFrame:
        """The leaves of all trees: ``round, genre, node, value``, the value being what a score gains there."""
        rows = [
            (number, genre, node, tree.value[node] / UNIT)
            for number, grown in enumerate(self.ensemble.trees)
            for genre, tree in zip(self.genres, grown, strict=True)
            for node, feature in enumerate(tree.feature)
            if feature < 0
        ]
        return local_frame(spark, {"round": COUNT, "genre": TEXT, "node": COUNT, "value": NUMBER}, rows)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write cuts, means and trees as three tables."""
        cuts = {"position": COUNT, "cuts": NUMBERS}
        base = {"genre": TEXT, "base": COUNT}
        trees = {"round": COUNT, "genre": TEXT} | {c: _NODES for c in ("feature", "bin", "left", "value")}
        rows = [
            (number, genre, tree.feature, tree.bin, tree.left, tree.value)
            for number, grown in enumerate(self.ensemble.trees)
            for genre, tree in zip(self.genres, grown, strict=True)
        ]
        tables = {
            "cuts": local_frame(spark, cuts, list(enumerate(self.ensemble.cuts))),
            "base": local_frame(spark, base, list(zip(self.genres, self.ensemble.base, strict=True))),
            "trees": local_frame(spark, trees, rows),
        }
        for name, table in tables.items():
            write_parquet(table, f"{path}/{name}", "overwrite")

    @classmethod
    def load(cls, spark: SparkSession, path: str, genres: Sequence[str]) -> MultiOutputModel:
        """The model that was saved there for just these genres."""
        ordered = tuple(sorted(genres))
        base = {row["genre"]: row["base"] for row in spark.read.parquet(f"{path}/base").collect()}
        if set(base) != set(ordered):
            raise ValueError(f"the model at {path} is for {sorted(base)}")
        cuts = sorted((row["position"], list(row["cuts"])) for row in spark.read.parquet(f"{path}/cuts").collect())
        rounds: dict[int, dict[str, Tree]] = {}
        for row in spark.read.parquet(f"{path}/trees").collect():
            tree = Tree(*(list(row[c]) for c in ("feature", "bin", "left", "value")))
            rounds.setdefault(row["round"], {})[row["genre"]] = tree
        trees = [[grown[genre] for genre in ordered] for _, grown in sorted(rounds.items())]
        return cls(ordered, Ensemble([own for _, own in cuts], [base[genre] for genre in ordered], trees))


def fit_multi_output(
    matrix: DataFrame, labels: DataFrame, genres: Sequence[str], params: BoostingParams
) -> MultiOutputModel:
    """Fit one regressor per genre on the rows both wide tables have."""
    ordered = tuple(sorted(genres))
    named = zip(ordered, target_columns(ordered), strict=True)
    renamed = labels.select("userId", *[F.col(f"`{genre}`").alias(target) for genre, target in named])
    return fit_rows(matrix.join(renamed, "userId"), ordered, params)


def fit_rows(rows: DataFrame, genres: Sequence[str], params: BoostingParams) -> MultiOutputModel:
    """Fit one regressor per genre on rows that hold features and labels (``matrix.pivot_training``)."""
    ordered = tuple(sorted(genres))
    return MultiOutputModel(ordered, fit(rows, feature_columns(ordered), target_columns(ordered), params))


def scoring_matrix(user_genre: DataFrame, profiles: DataFrame, genres: Sequence[str]) -> DataFrame:
    """Feature matrix of every user that has a listed genre, columns as the model expects them."""
    listed = user_genre.where(F.col("genre").isin(*genres))
    return pivot_features(listed.join(profiles, "userId", "left"), genres)


def batch_score(user_genre: DataFrame, profiles: DataFrame, model: MultiOutputModel) -> DataFrame:
    """A score per genre for every user."""
    return model.predict(scoring_matrix(user_genre, profiles, model.genres))
