import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from palate.operators import features
from palate.settings import GENRE_FEATURES, PROFILE_FEATURES
from tests.conftest import rows_of

DAY = 86400


def test_recency_decays_from_the_users_latest_rating(frames):
    ratings = frames.ratings((1, 10, 4.0, 200 * DAY), (1, 11, 3.0, 100 * DAY))
    exploded = frames.exploded((10, "Action"), (11, "Action"))
    (row,) = features.user_genre_features(ratings, exploded, frames.genome(), frames.tags()).collect()
    assert row.genre_recency_score == pytest.approx((4.0 + 3.0 * math.exp(-0.1)) / 2, rel=1e-12)


def test_latest_rating_counts_even_without_genres(frames):
    ratings = frames.ratings((1, 10, 4.0, 100 * DAY), (1, 99, 1.0, 300 * DAY))
    (row,) = features.user_genre_features(ratings, frames.exploded((10, "A")), frames.genome(), frames.tags()).collect()
    assert (row.genre, row.genre_watch_count) == ("A", 1)
    assert row.genre_recency_score == pytest.approx(4.0 * math.exp(-0.2), rel=1e-12)


@pytest.mark.parametrize("rate", [0.0, 0.001, 0.5, 3.0, 400.0])
def test_any_decay_rate_matches_the_direct_formula(frames, rate):
    stamps = [0, 5 * DAY, 40 * DAY, 41 * DAY, 9000 * DAY, 9000 * DAY + 3600]
    ratings = frames.ratings(*[(1, m, float(m + 1), t) for m, t in enumerate(stamps)])
    exploded = frames.exploded(*[(m, "A") for m in range(len(stamps))])
    (row,) = features.user_genre_features(ratings, exploded, frames.genome(), frames.tags(), rate).collect()
    expected = sum((m + 1) * math.exp(-rate * (stamps[-1] - t) / DAY) for m, t in enumerate(stamps)) / len(stamps)
    assert row.genre_recency_score == pytest.approx(expected, rel=1e-9)


def test_shares_sum_to_one_and_entropy_is_bounded(frames):
    ratings = frames.ratings(*[(u, m, 3.0, m) for u in range(3) for m in range(u, 9)])
    exploded = frames.exploded(*[(m, g) for m in range(9) for g in ("A", "B", "C")[: m % 3 + 1]])
    result = features.user_genre_features(ratings, exploded, frames.genome(), frames.tags())
    for row in result.groupBy("userId").agg(F.sum("genre_share").alias("s"), F.max("genre_diversity_index").alias("h")).collect():
        assert row.s == pytest.approx(1.0)
        assert 0 <= row.h <= math.log(3) + 1e-12


def test_entropy_of_one_and_of_three_equal_genres(frames):
    ratings = frames.ratings((1, 1, 3.0, 1), (2, 1, 3.0, 1), (2, 2, 3.0, 1), (2, 3, 3.0, 1))
    exploded = frames.exploded((1, "A"), (2, "B"), (3, "C"))
    result = features.user_genre_features(ratings, exploded, frames.genome(), frames.tags())
    entropy = {r.userId: r.genre_diversity_index for r in result.collect()}
    assert entropy == {1: 0.0, 2: pytest.approx(math.log(3))}
    profile = {r.userId: r.diversity_index for r in features.user_profile_features(ratings, exploded).collect()}
    assert profile == {1: 0.0, 2: pytest.approx(math.log(3))}


def test_relevance_ignores_movies_without_any_and_stays_null(frames):
    ratings = frames.ratings((1, 1, 3.0, 1), (1, 2, 3.0, 1), (1, 3, 3.0, 1))
    exploded = frames.exploded((1, "A"), (2, "A"), (3, "B"))
    result = features.user_genre_features(ratings, exploded, frames.genome((1, "A", 0.25)), frames.tags())
    assert rows_of(result, "genre", "genre_avg_genome_relevance", "genre_watch_count") == [("A", 0.25, 2), ("B", None, 1)]


def test_tags_count_distinct_words_on_any_movie_of_a_rated_genre(frames):
    ratings = frames.ratings((1, 1, 3.0, 1))
    exploded = frames.exploded((1, "A"), (2, "A"), (2, "B"), (3, "C"))
    tags = frames.tags((1, 2, "x", 1), (1, 1, "x", 2), (1, 1, "y", 3), (1, 3, "z", 4), (2, 1, "w", 5), (1, 77, "q", 6))
    result = features.user_genre_features(ratings, exploded, frames.genome(), tags)
    assert rows_of(result, "userId", "genre", "genre_tag_count") == [(1, "A", 2)]


def test_profile_covers_all_ratings_but_needs_a_genre(frames):
    ratings = frames.ratings((1, 1, 4.0, 0), (1, 99, 2.0, DAY + DAY // 2), (2, 99, 5.0, 0))
    (row,) = features.user_profile_features(ratings, frames.exploded((1, "A"), (1, "B"))).collect()
    assert (row.userId, row.total_ratings, row.avg_rating, row.active_days, row.distinct_genres) == (1, 2, 3.0, 1.5, 2)


def test_column_sets(frames):
    user_genre = features.user_genre_features(frames.ratings(), frames.exploded(), frames.genome(), frames.tags())
    assert user_genre.columns == ["userId", "genre", *GENRE_FEATURES, "feature_timestamp"]
    assert dict(user_genre.dtypes)["genre_tag_count"] == "bigint"
    profile = features.user_profile_features(frames.ratings(), frames.exploded())
    assert profile.columns == ["userId", *PROFILE_FEATURES, "profile_timestamp"]


def test_against_a_plain_computation(spark, frames):
    genres = {m: [g for i, g in enumerate("ABCD") if (m >> i) & 1] for m in range(16)}
    rows = [(u, (u * 7 + k * 3) % 16, (k % 10 + 1) * 0.5, k * 997 + u) for u in range(9) for k in range(11)]
    result = features.user_genre_features(
        frames.ratings(*rows),
        frames.exploded(*[(m, g) for m, listed in genres.items() for g in listed]),
        frames.genome(),
        frames.tags(),
    )
    latest = {u: max(t for v, _, _, t in rows if v == u) for u in range(9)}
    ratings, decayed = defaultdict(list), Counter()
    for u, m, r, t in rows:
        for g in genres[m]:
            ratings[u, g].append(r)
            decayed[u, g] += r * math.exp(-0.001 * (latest[u] - t) / DAY)
    found = {(r.userId, r.genre): r for r in result.collect()}
    assert found.keys() == ratings.keys()
    for key, values in ratings.items():
        assert found[key].genre_avg_rating == pytest.approx(sum(values) / len(values))
        assert found[key].genre_watch_count == len(values)
        assert found[key].genre_recency_score == pytest.approx(decayed[key] / len(values))


def test_sampling_keeps_whole_users_and_agrees_across_tables(spark, frames):
    ratings = frames.ratings(*[(u, m, 3.0, 1) for u in range(200) for m in range(3)])
    tags = frames.tags(*[(u, 1, "x", 1) for u in range(200)])
    kept = features.sample_users(ratings, 0.5)
    users = {r.userId for r in kept.collect()}
    assert 70 <= len(users) <= 130
    assert kept.count() == 3 * len(users)
    assert {r.userId for r in features.sample_users(tags, 0.5).collect()} == users
    assert {r.userId for r in features.sample_users(ratings.repartition(7), 0.5).collect()} == users
    assert {r.userId for r in features.sample_users(ratings, 0.5, seed=1).collect()} != users
    assert features.sample_users(ratings, 1.0) is ratings


def test_tags_of_a_user_are_moved_once(frames):
    tags = frames.tags((1, 1, "x", 1), (1, 2, "x", 2), (1, 1, "y", 3), (1, 2, None, 4), (2, 1, None, 5), (2, 9, "x", 6), (1, 1, "x", 7))
    counted = features.tag_counts(tags, frames.exploded((1, "A"), (1, "B"), (1, "B"), (2, "A"), (3, "C")))
    assert rows_of(counted, "userId", "genre", "tag_count") == [(1, "A", 2), (1, "B", 2), (2, "A", 0), (2, "B", 0)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(userId" in plan
    assert not any("hashpartitioning(" in line and "genre" in line for line in plan.splitlines())
