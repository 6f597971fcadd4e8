import json
import math
import random

import numpy as np
import pytest

from palate.operators import drift
from tests.conftest import rows_of


def frame(spark, **keys):
    return spark.createDataFrame([(k, float(v)) for k, vs in keys.items() for v in vs], "key STRING, value DOUBLE")


def plain_psi(baseline, current, bins=10):
    edges = np.unique(np.percentile(baseline, np.linspace(0, 100, bins + 1)))
    if len(edges) < 3:
        return 0.0
    edges[-1] += 1e-6
    shares = []
    for values in (baseline, current):
        counted = np.histogram(values, bins=edges)[0]
        shares.append((counted + 1e-6) / (counted.sum() + len(counted) * 1e-6))
    return float(((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum())


def cases():
    rng = random.Random(3)
    base = [rng.gauss(0, 1) for _ in range(300)]
    return {
        "same": (base, base),
        "shifted": (base, [v + 0.8 for v in base]),
        "out_of_range": (base, [v + 1000 for v in base]),
        "ties": ([1.0] * 90 + [2.0] * 6 + [3.0] * 4, [1.0] * 50 + [3.0] * 50),
        "steps": ([i % 7 for i in range(200)], [i % 5 for i in range(150)]),
        "gap": ([0.0] * 50 + [1.0] * 45, [0.0] * 10 + [0.5] * 20 + [1.0] * 3),
        "constant": ([4.0] * 20, [5.0] * 20),
        "two_values": ([0.0, 1.0] * 30, [1.0] * 40),
        "last_edge": (list(range(11)), [10.0] * 15),
        "short": ([1.0, 2.0, 5.0], [1.5, 4.0]),
    }


def test_psi_matches_the_array_computation(spark):
    data = cases()
    base = frame(spark, other=[1.0], **{k: b for k, (b, _) in data.items()})
    now = frame(spark, other=[2.0], **{k: c for k, (_, c) in data.items()})
    found = drift.psi(base, now, list(data))
    values = dict(rows_of(found))
    assert values.keys() == data.keys()
    for key, (base, now) in data.items():
        assert values[key] == pytest.approx(plain_psi(base, now), abs=1e-9), key
    assert values["same"] == 0.0 and values["constant"] == 0.0


def test_nothing_to_compare(spark):
    assert drift.psi(frame(spark, a=[1.0]), frame(spark, b=[1.0]), ["a", "b"]).collect() == []


def features(spark, n, shift, nulls=0):
    rows = [(i + shift, None if i < nulls else float(i % 13)) for i in range(n)]
    return spark.createDataFrame(rows, "genre_watch_count BIGINT, genre_share DOUBLE")


def test_report_skips_features_with_too_few_values(spark):
    names = ("genre_watch_count", "genre_share")
    report = drift.drift_report(features(spark, 40, 0), features(spark, 40, 25, nulls=30), names)
    ((name, value, drifted),) = rows_of(report)
    assert (name, drifted) == ("genre_watch_count", True) and value > 0.2


def test_summary_row(spark):
    names = ("genre_watch_count", "genre_share")
    report = drift.drift_report(features(spark, 40, 0), features(spark, 40, 25), names)
    row = drift.drift_summary(report, names).first()
    logged = json.loads(row.feature_psi)
    assert list(logged) == list(names) and logged["genre_share"] == 0.0
    assert math.isnan(row.prediction_psi) and row.drift_detected is True
    empty = drift.drift_summary(report.limit(0), names).first()
    assert (empty.feature_psi, empty.drift_detected) == ("{}", False)


def test_values_leave_out_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 3), (float("nan"), None)], "a DOUBLE, b BIGINT")
    assert rows_of(drift.feature_values(df, ["a", "b"])) == [("a", 1.0), ("b", 2.0), ("b", 3.0)]
