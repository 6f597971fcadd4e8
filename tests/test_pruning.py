"""Filters on time skip row groups, merges and pivots do their work once, and odd values are not lost."""

import math
import re

import pytest
from pyspark.sql import functions as F

from palate.functions.expressions import after
from palate.functions.quantiles import time_quantiles
from palate.operators import matrix, metrics, silver, validation
from palate.operators.drift import drift_report, drift_summary, psi
from palate.settings import GENRE_FEATURES, PROFILE_FEATURES
from palate.sources import csv
from palate.sources.scratch import stage
from palate.streaming.replay import advance_window


def rows_scanned(df):
    """Rows that the scans of a plan gave out when it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if "QueryStage" in node.nodeName():
            walk(node.plan())

    walk(plan)
    return sum(found)


@pytest.fixture
def by_time(spark, store):
    seconds = F.timestamp_seconds(F.col("id") * 1000)
    ratings = spark.range(0, 100_000, 1, 10).select(
        (F.col("id") % 500).alias("userId"), (F.col("id") % 700).alias("movieId"), F.lit(3.0).alias("rating"),
        seconds.alias("timestamp"),
    )
    return store.overwrite("ratings", ratings)


def test_time_filters_read_matching_files_only(by_time):
    assert rows_scanned(by_time.where(after(79_999_000))) == 20_000
    training, holdout = silver.split_holdout(by_time)
    assert rows_scanned(holdout) <= 20_000 + 10_000
    assert rows_scanned(training) <= 80_000 + 10_000
    moved, _ = advance_window(stage(holdout, "holdout"), days=30)
    assert moved.count() == 30 * 86_400 // 1000 + 1


def test_staged_copies_keep_time_statistics(by_time):
    assert 10_000 <= rows_scanned(stage(by_time, "copy").where(after(89_999_000))) < 50_000


def test_quantiles_of_times_that_are_all_different(spark):
    days = spark.range(0, 50_000).select(F.timestamp_seconds(F.col("id") * 86_400 * 7).alias("timestamp"))
    rows = {r.position: r.epoch for r in time_quantiles(days, [0.0, 0.6, 0.8, 1.0]).collect()}
    week = 86_400 * 7
    assert rows == {0: 0, 1: 29_999 * week, 2: 39_999 * week, 3: 49_999 * week}
    assert time_quantiles(days.limit(0), [0.5]).count() == 0


def test_a_merge_computes_its_updates_once(spark, store):
    store.overwrite("t", spark.createDataFrame([(1, 0.0), (2, 0.0)], "k long, v double"))
    noisy = spark.range(2, 6).select(F.col("id").alias("k"), F.rand().alias("v"))
    merged = store.upsert("t", noisy, ["k"]).collect()
    assert sorted(r.k for r in merged) == [1, 2, 3, 4, 5]


def test_old_versions_go_and_the_last_one_stays_readable(spark, store):
    first = store.overwrite("t", spark.range(1))
    store.overwrite("t", spark.range(2))
    assert first.count() == 1
    store.overwrite("t", spark.range(3))
    assert store._versions("t") == [2, 3]


def test_slices_need_a_sliced_table(spark, store):
    with pytest.raises(LookupError):
        store.write_slice("none", spark.range(1), 1)
    store.overwrite("plain", spark.range(1))
    with pytest.raises(LookupError):
        store.write_slice("plain", spark.range(1), 1)


def test_pivots_shuffle_once(spark):
    names = [*PROFILE_FEATURES, *GENRE_FEATURES]
    cells = spark.range(0, 3000).select(
        (F.col("id") % 900).alias("userId"), F.element_at(F.array(F.lit("A"), F.lit("B")), (F.col("id") % 2 + 1).cast("int")).alias("genre"),
        F.lit(1.0).alias("label"), *[F.lit(1.0).alias(n) for n in names],
    )
    cells = stage(cells, "cells")
    for wide in (matrix.pivot_features(cells, "AB"), matrix.pivot_labels(cells, "AB")):
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


CELLS = "variant string, genre string, slice string, userId long, y double, p double, champion double"


def _cells(spark, p, champion):
    rows = [("v", g, s, u, float(u % 5), p(g, s, u), champion(g, s, u)) for g in "AB" for s in ("low", "high") for u in range(8)]
    return spark.createDataFrame(rows, CELLS)


def good(g, s, u):
    return float(u % 5)


@pytest.mark.parametrize("gap", [None, math.nan])
def test_a_missing_prediction_fails(spark, gap):
    def broken(g, s, u):
        return gap if (g, s, u) == ("A", "low", 3) else good(g, s, u)

    by_champion = _cells(spark, good, broken)
    assert metrics.compare_champion(by_champion).first().passed is False
    report = {r.check_name: r.passed for r in validation.validation_report(by_champion).collect()}
    assert [name for name, passed in report.items() if not passed] == ["champion"]
    by_challenger = _cells(spark, broken, good)
    assert metrics.compare_champion(by_challenger).first().passed is False
    report = {r.check_name: r.passed for r in validation.validation_report(by_challenger).collect()}
    assert report == {
        "smoke_test": True, "rmse": False, "r2": False, "champion": False, "genre_rmse": False, "slice_r2": False
    }


def test_only_an_absent_champion_is_skipped(spark):
    assert metrics.compare_champion(_cells(spark, good, lambda *_: None)).first().passed is None


def test_slices_with_missing_predictions_fail_and_tiny_ones_pass(spark):
    cells = spark.createDataFrame(
        [(1, "A", 1.0, 1.0), (2, "A", 2.0, None), (2, "B", 2.0, 2.0), (3, "A", 2.0, 2.0), (3, "B", 2.0, 2.0)],
        "userId long, genre string, y double, p double",
    )
    ratings = spark.createDataFrame([(1,)] + [(2,)] * 5 + [(3,)] * 10, "userId long")
    verdicts = {r.slice: r.passed for r in metrics.activity_slices(cells, ratings, 3, 7).collect()}
    assert verdicts == {"low": True, "medium": False, "high": True}


def test_an_infinite_value_spoils_its_own_key_alone(spark):
    rows = [("a", float(i)) for i in range(50)] + [("b", float(i)) for i in range(50)] + [("b", math.inf), ("c", -1e308), ("c", 1e308)]
    values = spark.createDataFrame(rows, "key string, value double")
    assert {r.key: r.psi for r in psi(values, values, ["a", "b", "c"]).collect()} == {"a": 0.0, "b": None, "c": None}
    wide = spark.createDataFrame([(float(i), math.inf if i == 7 else float(i)) for i in range(40)], "f double, g double")
    report = drift_report(wide, wide, ["f", "g"])
    assert {r.feature: (r.psi, r.drifted) for r in report.collect()} == {"f": (0.0, False), "g": (None, True)}
    log = drift_summary(report, ["f", "g"]).first()
    assert log.drift_detected and log.feature_psi == '{"f":0.000000,"g":null}'


def test_malformed_values_stop_the_load(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,rating\n1,3.5\n2,many\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_csv(spark, str(tmp_path / "r.csv"), "userId LONG, rating DOUBLE").collect()
