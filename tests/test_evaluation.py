import math
import random

import pytest
from pyspark.sql import functions as F

from palate.operators import matrix, metrics, validation
from palate.settings import GENRE_FEATURES, PROFILE_FEATURES
from tests.conftest import rows_of

NAN = float("nan")


def feature_cells(spark, rows):
    columns = ", ".join(f"{c} DOUBLE" for c in (*PROFILE_FEATURES, *GENRE_FEATURES))
    return spark.createDataFrame(rows, f"userId BIGINT, genre STRING, label DOUBLE, {columns}")


def cell(user, genre, label, scale):
    return (user, genre, label, *[float(user)] * 5, *[scale + i for i in range(7)])


def test_label_matrix(spark):
    cells = spark.createDataFrame(
        [(1, "Drama", 4.0), (1, "Drama", 2.0), (1, "Sci-Fi", 5.0), (2, "IMAX", 3.0), (3, "Drama", None)],
        "userId BIGINT, genre STRING, label DOUBLE",
    )
    wide = matrix.pivot_labels(cells, ["Sci-Fi", "Drama", "War"])
    assert wide.columns == ["userId", "Drama", "Sci-Fi", "War"]
    assert rows_of(wide) == [(1, 3.0, 5.0, 0.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0)]


def test_feature_matrix_shape_names_and_zeros(spark):
    genres = ["B", "A", "C-D"]
    cells = feature_cells(spark, [cell(1, "A", 1.0, 10.0), cell(1, "C-D", 2.0, 20.0), cell(2, "X", 3.0, 30.0)])
    wide = matrix.pivot_features(cells, genres)
    assert wide.columns == ["userId", *matrix.feature_columns(genres)]
    assert len(wide.columns) == 1 + 5 + 7 * 3
    rows = {r.userId: r for r in wide.collect()}
    assert rows[1]["genre_avg_rating_A"] == 10.0
    assert rows[1]["genre_tag_count_C-D"] == 26.0
    assert rows[1]["genre_share_B"] == 0.0
    assert rows[2]["total_ratings"] == 2.0
    assert all(rows[2][c] == 0.0 for c in matrix.feature_columns(genres)[5:])


def test_missing_profile_is_zero(spark):
    row = (1, "A", 0.0, *[None] * 5, *[1.0] * 7)
    assert matrix.pivot_features(feature_cells(spark, [row]), ["A"]).first().total_ratings == 0.0


def test_dense_cells_equal_the_wide_matrix(spark):
    cells = spark.createDataFrame([(1, "A", 4.0), (2, "B", 2.0)], "userId BIGINT, genre STRING, label DOUBLE")
    assert rows_of(matrix.dense_cells(cells, ["A", "B"])) == [(1, "A", 4.0), (1, "B", 0.0), (2, "A", 0.0), (2, "B", 2.0)]


def test_prediction_cells_pair_labels_with_every_prediction(spark):
    wide = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "userId BIGINT, A DOUBLE, B DOUBLE")
    other = wide.select("userId", (F.col("A") * 10).alias("A"), (F.col("B") * 10).alias("B"))
    cells = matrix.prediction_cells(wide, ["B", "A"], p=other, champion=wide)
    assert cells.columns == ["userId", "genre", "y", "p", "champion"]
    assert rows_of(cells)[:2] == [(1, "A", 1.0, 10.0, 1.0), (1, "B", 2.0, 20.0, 2.0)]


def noisy(frames, spread, users=50):
    rng = random.Random(7)
    rows = []
    for user in range(users):
        for genre in "ABC":
            y = rng.uniform(0, 5)
            rows.append((user, genre, y, y + rng.gauss(0, spread)))
    return rows, frames.cells(*rows)


def r2(pairs):
    mean = sum(y for y, _ in pairs) / len(pairs)
    return 1 - sum((y - p) ** 2 for y, p in pairs) / sum((y - mean) ** 2 for y, _ in pairs)


def test_metrics_against_plain_formulas(frames):
    rows, cells = noisy(frames, 0.7)
    (overall,) = metrics.metrics_overall(cells).collect()
    assert overall.rmse_overall == pytest.approx(math.sqrt(sum((y - p) ** 2 for *_, y, p in rows) / len(rows)))
    by_genre = {g: [(y, p) for _, h, y, p in rows if h == g] for g in "ABC"}
    assert overall.r2_overall == pytest.approx(sum(map(r2, by_genre.values())) / 3)
    found = dict(rows_of(metrics.metrics_per_genre(cells)))
    for genre, pairs in by_genre.items():
        assert found[genre] == pytest.approx(math.sqrt(sum((y - p) ** 2 for y, p in pairs) / len(pairs)))


def test_r2_of_constant_labels_and_single_rows(frames):
    cells = frames.cells((1, "met", 2.0, 2.0), (2, "met", 2.0, 2.0), (1, "missed", 2.0, 2.0), (2, "missed", 2.0, 3.0))
    assert metrics.metrics_overall(cells).first().r2_overall == 0.5
    assert math.isnan(metrics.metrics_overall(frames.cells((1, "one", 2.0, 2.0))).first().r2_overall)


def with_variant(cells, champion=None, slices="medium"):
    return cells.withColumns(
        {"champion": F.lit(champion).cast("double"), "slice": F.lit(slices), "variant": F.lit("general")}
    )


def outcome(report):
    return {r.check_name: r.passed for r in report.collect()}


def test_good_predictions_pass_every_check(frames):
    report = validation.validation_report(with_variant(noisy(frames, 0.05)[1], champion=0.0))
    assert set(outcome(report).values()) == {True}
    assert rows_of(validation.variant_status(report)) == [("general", "PASSED")]


def test_large_errors_fail(frames):
    report = validation.validation_report(with_variant(noisy(frames, 6.0)[1]))
    passed = outcome(report)
    assert passed == {
        "smoke_test": True, "rmse": False, "r2": False, "champion": None, "genre_rmse": False, "slice_r2": False,
    }
    assert rows_of(validation.variant_status(report)) == [("general", "FAILED")]


def flat_error(frames, error):
    return frames.cells(*[(u, g, float(u), float(u) + error) for u in range(20) for g in "AB"])


@pytest.mark.parametrize(("error", "passed"), [(1.49, True), (1.5, False)])
def test_rmse_limit_itself_fails(frames, error, passed):
    assert outcome(validation.validation_report(with_variant(flat_error(frames, error))))["rmse"] is passed


def test_genre_limit_itself_passes(frames):
    assert outcome(validation.validation_report(with_variant(flat_error(frames, 2.0))))["genre_rmse"] is True


def test_a_single_bad_genre_fails_only_its_check(frames):
    rows = [(u, g, float(u), float(u) + (2.1 if g == "A" else 0.0)) for u in range(20) for g in "ABCDEFGH"]
    passed = outcome(validation.validation_report(with_variant(frames.cells(*rows))))
    assert passed["rmse"] and not passed["genre_rmse"]


def test_a_bad_slice_fails(frames):
    rows = [(u, "A", float(u), float(u) if u < 40 else float(90 - u)) for u in range(50)]
    cells = with_variant(frames.cells(*rows)).withColumn("slice", F.when(F.col("userId") < 40, "low").otherwise("high"))
    report = validation.validation_report(cells)
    assert outcome(report)["slice_r2"] is False
    assert outcome(report)["r2"] is True


def test_champion_tie_passes_and_worse_fails(frames):
    cells = frames.cells((1, "A", 1.0, 2.0), (2, "A", 3.0, 2.0))
    tie = cells.withColumn("champion", F.col("p"))
    assert metrics.compare_champion(tie).first().passed is True
    better = cells.withColumn("champion", F.col("y"))
    assert metrics.compare_champion(better).first().passed is False
    none = cells.withColumn("champion", F.lit(None).cast("double"))
    assert tuple(metrics.compare_champion(none).first()) == (1.0, None, None)


@pytest.mark.parametrize(("p", "passed"), [(1.0, True), (NAN, False), (None, False)])
def test_smoke(frames, p, passed):
    row = metrics.smoke_test(frames.cells((1, "A", 1.0, p), (2, "A", 1.0, NAN))).first()
    assert (row.predictions, row.passed) == (2, passed)


def test_missing_predictions_fail_the_report(frames):
    passed = outcome(validation.validation_report(with_variant(frames.cells((1, "A", 1.0, None), (2, "A", 2.0, 2.0)))))
    assert passed["smoke_test"] is True and passed["rmse"] is False


def test_activity_slices_and_their_limits(frames):
    cells = frames.cells(*[(u, g, float(u + k), float(u + k)) for k, g in enumerate("AB") for u in range(6)])
    counts = {0: 49, 1: 50, 2: 200, 3: 201, 4: 300}
    ratings = frames.ratings(*[(u, m, 3.0, 1) for u, n in counts.items() for m in range(n)])
    sliced = dict(rows_of(metrics.with_activity(cells, ratings).where("genre = 'A'"), "userId", "slice"))
    assert sliced == {0: "low", 1: "medium", 2: "medium", 3: "high", 4: "high", 5: "low"}
    assert rows_of(metrics.activity_slices(cells, ratings)) == [
        ("high", 2, 1.0, True), ("low", 2, 1.0, True), ("medium", 2, 1.0, True),
    ]
    assert rows_of(metrics.activity_slices(cells.where("userId > 2"), ratings), "slice") == [("high",), ("low",)]


def report_of(spark, **variants):
    rows = [(v, "rmse", passed) for v, checks in variants.items() for passed in checks]
    return spark.createDataFrame(rows, "variant STRING, check_name STRING, passed BOOLEAN")


@pytest.mark.parametrize(
    ("variants", "promoted"),
    [
        ({"general": [True, None], "nokids": [True]}, True),
        ({"general": [True], "nokids": [True, False]}, False),
        ({"general": [True]}, False),
        ({"general": [True], "other": [True]}, False),
    ],
)
def test_promotion_needs_every_variant(spark, variants, promoted):
    gate = validation.promotion_gate(report_of(spark, **variants), ["general", "nokids"]).first()
    assert gate.promoted is promoted
