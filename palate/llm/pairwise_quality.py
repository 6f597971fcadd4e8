"""Quality score of every text, learned from preferences: a text labelled 1 is preferred to a text labelled 0.

By the model of Bradley and Terry a text of strength s is preferred to one of strength t with probability
``1 / (1 + exp(t - s))``. Strength is linear in a text's features, so the weights minimise the logistic loss over the
differences of features of preferred and other texts, without an intercept; Spark fits them over a table of pairs.
The score is the logistic function of strength, moved so that it is ``Learner.accept`` at the cut: the quantile of
strengths of labelled texts that parts the two labels best.

Texts are read once, without a shuffle. Pairs come from hashing: equal feature rows of one label count once, the
points of either label go to ``copies`` of as many slots as the rarer label has points, and pairs are those of one
slot, so there are about ``copies ** 2`` for each point of the commoner label, whatever the size, and a point is left
without partner with a probability of ``exp(-copies ** 2)``. At most ``max_points`` points a label, those of smallest
hash, are fitted on, so the fit costs the same on any corpus; every text is scored. The driver holds the weights and
the candidate quantiles.

Defined results: a null or empty text has zeros for features and is scored like any other; labels other than 0 and 1
and labels of unknown documents are not used; a document labelled both is used as both; without labels of both kinds
every score is 0.5; repeated rows are separate rows; other columns are not read.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.common import WORD, map_batches, stage

_WORDS = re.compile(WORD)
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_MARKS = [ord(c) for c in "!?"]

#: Numbers between 0 and about 1 of a text; strength also sees their square roots, which tell a little from none.
_SHARES = ("symbols", "marks", "upper", "digits", "dup_lines", "same_as_last", "repeated_triples", "repeated_words")
_FEATURES = ("log_words", "word_length", *_SHARES)
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((name, pa.float64()) for name in _FEATURES)])


def describe(text: str | None) -> tuple[float, ...]:
    """The numbers of ``_FEATURES`` for one text; shares are of characters, lines, words or triples of words."""
    words = _WORDS.findall(text) if text else []
    if not words:
        return (0.0,) * len(_FEATURES)
    n, chars = len(words), sum(map(len, words))
    times = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    triples = max(n - 2, 0)
    return (
        math.log1p(n),
        chars / n,
        int(times[_SYMBOLS].sum()) / chars,
        int(times[_MARKS].sum()) / chars,
        int(times[65:91].sum()) / chars,
        int(times[48:58].sum()) / chars,
        1 - len(set(lines)) / len(lines),
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if triples else 0.0,
        1 - len(set(words)) / n,
    )


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features of every document."""

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            columns = zip(*map(describe, part["text"]), strict=True)
            yield {"doc_id": part["doc_id"], **dict(zip(_FEATURES, columns, strict=True))}

    return map_batches(docs, ["doc_id", "text"], run, _SCHEMA)


def _inputs() -> dict[str, Column]:
    return {name: F.col(name) for name in _FEATURES} | {f"{name}_root": F.sqrt(name) for name in _SHARES}


@dataclass(frozen=True)
class Model:
    """Weights per input, and the strength at which a text is just accepted."""

    weights: dict[str, float]
    cut: float
    accept: float

    def strength(self) -> Column:
        inputs = _inputs()
        return sum((inputs[name] * F.lit(weight) for name, weight in self.weights.items()), F.lit(0.0))

    def score(self) -> Column:
        if not self.weights:
            return F.lit(0.5)
        odds = self.strength() - F.lit(self.cut) + F.lit(math.log(self.accept / (1 - self.accept)))
        return F.lit(1.0) / (1 + F.exp(-odds))


@dataclass(frozen=True)
class Learner:
    max_points: int = 20_000
    copies: int = 4
    penalty: float = 1e-4
    accept: float = 0.3
    quantiles: int = 512
    seed: int = 11

    def fit(self, features: DataFrame, labels: DataFrame) -> Model:
        """The model for ``labels(doc_id, quality)``, 1 being preferred to 0."""
        # A small table of its own, so that the join may be split where one document has many rows.
        known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        known = stage(known.select("doc_id", (F.col("quality") == 1).alias("high")).distinct(), "preferences")
        rows = stage(features.join(known, "doc_id").select("high", *_FEATURES), "labelled")
        points = self._points(rows)
        pairs = self._pairs(points)
        if pairs is None:
            return Model({}, 0.0, self.accept)
        weights = self._weights(pairs)
        return Model(weights, self._cut(rows, Model(weights, 0.0, self.accept)), self.accept)

    def _points(self, rows: DataFrame) -> DataFrame:
        """Different rows of features by label, a bounded number of each."""
        hashed = rows.distinct().withColumn("order", F.xxhash64(*_FEATURES, F.lit(self.seed)).cast("double"))
        hashed = stage(hashed, "points")
        counts = hashed.groupBy("high").agg(F.count("*").alias("n")).collect()
        share = {row["high"]: min(1.0, self.max_points / row["n"]) for row in counts}
        upto = F.when(F.col("high"), share.get(True, 0.0)).otherwise(share.get(False, 0.0))
        return hashed.where(F.col("order") / 2.0**64 + 0.5 <= upto).drop("order")

    def _pairs(self, points: DataFrame) -> DataFrame | None:
        """Differences of the inputs of preferred and other points, ``label`` telling which was taken from which."""
        points = stage(points.select("high", *[c.alias(name) for name, c in _inputs().items()]), "points")
        counts = {row["high"]: row["n"] for row in points.groupBy("high").agg(F.count("*").alias("n")).collect()}
        if len(counts) < 2:
            return None
        slots = min(counts.values())
        copy = F.explode(F.sequence(F.lit(1), F.lit(self.copies))).alias("copy")
        dealt = points.select("*", copy).withColumn("slot", F.pmod(F.xxhash64("copy", *_FEATURES), F.lit(slots)))
        high, low = (dealt.where(which).alias(name) for name, which in (("h", "high"), ("l", "not high")))
        label = F.pmod(F.xxhash64("h.slot", *[f"h.{n}" for n in _FEATURES], *[f"l.{n}" for n in _FEATURES]), F.lit(2))
        sign = 2 * label - 1
        return high.join(low, F.col("h.slot") == F.col("l.slot")).select(
            label.cast("double").alias("label"),
            *[(sign * (F.col(f"h.{name}") - F.col(f"l.{name}"))).alias(name) for name in _inputs()],
        )

    def _weights(self, pairs: DataFrame) -> dict[str, float]:
        names = list(_inputs())
        table = VectorAssembler(inputCols=names, outputCol="features").transform(pairs).select("label", "features")
        table = stage(table, "pairs")
        learner = LogisticRegression(fitIntercept=False, regParam=self.penalty, maxIter=100)
        return dict(zip(names, learner.fit(table).coefficients.toArray().tolist(), strict=True))

    def _cut(self, rows: DataFrame, model: Model) -> float:
        """The quantile of strengths above which most texts are labelled 1 and below which most are labelled 0."""
        strengths = rows.select("high", model.strength().alias("strength"))
        wanted = [i / self.quantiles for i in range(1, self.quantiles)]
        found = strengths.agg(F.percentile_approx("strength", wanted, 100 * self.quantiles)).first()[0]
        cuts = sorted(set(found))
        place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col("strength")))
        high, low = np.zeros(len(cuts) + 1, int), np.zeros(len(cuts) + 1, int)
        for row in strengths.groupBy(place.alias("place"), "high").agg(F.count("*").alias("n")).collect():
            (high if row["high"] else low)[row["place"]] = row["n"]
        # Texts at or below cut i are refused: those of places 0 to i.
        wrong = np.cumsum(high)[:-1] + low.sum() - np.cumsum(low)[:-1]
        best = np.flatnonzero(wrong == wrong.min())
        at = int(best[len(best) // 2])
        beyond = strengths.where(F.col("strength") > cuts[at]).agg(F.min("strength")).first()[0]
        return cuts[at] if beyond is None else (cuts[at] + beyond) / 2


def held_out() -> Column:
    """Documents whose labels are not learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


def rate(docs: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; labels of held-out documents are not seen."""
    features = stage(measure(docs), "pairwise-features")
    model = learner.fit(features, labels.where(~held_out()))
    scored = features.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= learner.accept).cast("int"))
