import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from palate.llm.pairwise_quality import _FEATURES, Learner, Model, describe, held_out, measure, rate


def test_features():
    assert describe(None) == describe("") == describe(" \n") == (0.0,) * len(_FEATURES)
    found = dict(zip(_FEATURES, describe("AB ab ab # x1!\nAB ab ab # x1!\nq"), strict=True))
    assert math.isclose(found["log_words"], math.log1p(11)) and math.isclose(found["word_length"], 21 / 11)
    assert math.isclose(found["symbols"], 2 / 21) and math.isclose(found["marks"], 2 / 21)
    assert math.isclose(found["upper"], 4 / 21) and math.isclose(found["digits"], 2 / 21)
    assert math.isclose(found["dup_lines"], 1 / 3) and math.isclose(found["same_as_last"], 2 / 11)
    assert math.isclose(found["repeated_triples"], 3 / 9) and math.isclose(found["repeated_words"], 6 / 11)
    assert describe("w")[8] == 0.0 and describe("é ß é ß")[4] == 0.0


def labelled(spark, draw, n):
    """Rows of features of which two decide the label."""
    values = draw.random((n, len(_FEATURES)))
    high = values[:, 2] + 2 * values[:, 4] < 1.2
    rows = [(i, *map(float, v)) for i, v in enumerate(values)]
    features = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{f} double" for f in _FEATURES))
    return features, spark.createDataFrame([(i, int(h)) for i, h in enumerate(high)], "doc_id long, quality int"), high


def test_fit_against_newton_on_all_pairs(spark):
    features, labels, high = labelled(spark, np.random.default_rng(3), 300)
    model = Learner(copies=12, penalty=1e-2).fit(features, labels)
    inputs = np.array([[*row] for row in features.orderBy("doc_id").select(*_FEATURES).collect()])
    inputs = np.concatenate([inputs, np.sqrt(inputs[:, 2:])], axis=1)
    gaps = (inputs[high][:, None, :] - inputs[~high][None]).reshape(-1, inputs.shape[1])
    scale = np.concatenate([gaps, -gaps]).std(axis=0)
    gaps, weights = gaps / scale, np.zeros(inputs.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(gaps @ weights))
        slope = gaps.T @ p / len(gaps) - 1e-2 * weights
        curve = (gaps * (p * (1 - p))[:, None]).T @ gaps / len(gaps) + 1e-2 * np.eye(len(weights))
        weights += np.linalg.solve(curve, slope)
    strengths = inputs @ (weights / scale)
    found = [r.s for r in features.orderBy("doc_id").select(model.strength().alias("s")).collect()]
    assert np.corrcoef(strengths, found)[0, 1] > 0.995
    accepted = [r.s >= 0.3 for r in features.orderBy("doc_id").select(model.score().alias("s")).collect()]
    assert np.mean(np.array(accepted) == high) > 0.97


def test_few_points_are_enough_and_all_are_scored(spark):
    features, labels, high = labelled(spark, np.random.default_rng(4), 2000)
    model = Learner(max_points=200).fit(features, labels)
    accepted = [r.s >= 0.3 for r in features.orderBy("doc_id").select(model.score().alias("s")).collect()]
    assert len(accepted) == 2000 and np.mean(np.array(accepted) == high) > 0.95


def test_held_out_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet".replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{sf}/labels.parquet".replace("0.001", "0.01"))
    found = rate(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == docs.count()
    rows = found.join(labels, "doc_id").collect()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    unseen = [row for row in rows if row.held_out]
    assert len(unseen) > 30 and np.mean([r.predicted == r.quality for r in unseen]) > 0.95
    # Labels of held-out documents change nothing.
    other = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(rate(docs, other).collect()) == sorted(found.collect())


def test_odd_rows(docs_of, spark):
    texts = ["fine words are here today"] * 40 + ["BAD!! BAD!! BAD!!"] * 3 + [None, "", "### $$$", "ok " * 50_000]
    docs = docs_of(*enumerate(texts), (3, texts[41]), (None, "x")).withColumn("score", F.lit("mine"))
    labels = [(i, int(i < 40)) for i in range(43)] + [(4, None), (None, 0), (5, 7), (999, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = rate(docs, labels).collect()
    assert len(rows) == len(texts) + 2 and all(0 <= row.score <= 1 for row in rows)
    by_text = {texts[r.doc_id]: r.predicted for r in rows if r.doc_id is not None and r.doc_id != 3}
    assert by_text[texts[0]] == 1 and by_text[texts[41]] == 0
    assert {row.score for row in rate(docs, labels.where("quality = 1")).collect()} == {0.5}
    assert {row.predicted for row in rate(docs, labels.limit(0)).collect()} == {1}
    assert rate(docs.limit(0), labels).count() == 0 and measure(docs.limit(0)).count() == 0


def test_score_is_the_threshold_at_the_cut(spark):
    one = spark.createDataFrame([(0,) + (1.0,) * len(_FEATURES)], "doc_id long, " + ", ".join(f"{f} double" for f in _FEATURES))
    model = Model({"symbols": 2.0}, 2.0, 0.3)
    assert math.isclose(one.select(model.score()).first()[0], 0.3)
