"""Every query with an SQL twin gives the same rows in an independent engine."""

import pytest

import __spark_entry__ as entry_points
from palate.checks.oracles import ORACLES
from palate.checks.queries import QUERIES
from tools.compare import compare, connect

SMALLEST = "/root/testdata/sf0.001"
MODELS = {"fit_multi_output", "batch_score"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALLEST)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, SMALLEST, name).startswith("ok")


def test_only_model_fits_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == MODELS


def test_entry_points(spark):
    assert entry_points.queries().keys() >= QUERIES.keys()
    assert entry_points.oracle_sql().keys() >= ORACLES.keys()
    assert entry_points.entry(spark).columns[:2] == ["userId", "genre"]


def test_scores_cover_every_user_and_kept_genre(spark):
    scores = QUERIES["batch_score"](spark, SMALLEST)
    profiles = QUERIES["user_profile_features"](spark, SMALLEST)
    assert scores.count() == profiles.count()
    assert len(scores.columns) == 14
