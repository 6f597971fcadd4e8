"""The whole life of the tables on a small made-up data set with a clear signal."""

import json
import random

import pytest
from pyspark.sql import functions as F

from palate import settings
from palate.operators.model import MultiOutputModel
from palate.plans import bootstrap, serving, training
from palate.settings import BoostingParams, Variant
from palate.sources.tables import TableStore
from palate.sources import scratch
from palate.sources.files import child_names
from palate.streaming import replay
from tests.conftest import rows_of

DAY = settings.SECONDS_PER_DAY
GENRES = ("Action", "Comedy", "Drama")
GENERAL = Variant("general", GENRES, settings.MOVIES_EXPLODED, settings.SCORES_DAILY)
NOKIDS = Variant("nokids", GENRES[:2], settings.MOVIES_EXPLODED_NOKIDS, settings.SCORES_DAILY_NOKIDS)
PARAMS = BoostingParams(trees=3, learning_rate=0.5, leaves=8, min_rows_per_leaf=1)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("life")
    landing = root / "landing"
    landing.mkdir()
    rng = random.Random(5)
    movies = [(m, f"movie {m}", GENRES[m % 3]) for m in range(30)] + [(30, "odd", "(no genres listed)")]
    ratings = []
    for user in range(60):
        fond = GENRES[user % 3]
        for movie in rng.sample(range(31), 20):
            genre = movies[movie][2]
            stars = 4.5 if genre == fond else 2.0
            ratings.append((user, movie, stars + rng.choice((-0.5, 0, 0.5)), 1_000_000_000 + rng.randrange(400 * DAY)))
    ratings.append((0, ratings[0][1], 0.5, 1))  # an older duplicate
    rows = {
        "ratings": ["userId,movieId,rating,timestamp", *(",".join(map(str, r)) for r in ratings)],
        "movies": ["movieId,title,genres", *(",".join(map(str, m)) for m in movies)],
        "tags": ["userId,movieId,tag,timestamp", *(f"{u},{u % 30},word{u % 4},1000000000" for u in range(60))],
        "genome_scores": ["movieId,tagId,relevance", *(f"{m},{t},{(m + t) % 10 / 10}" for m in range(30) for t in (1, 2))],
        "genome_tags": ["tagId,tag", "1,one", "2,two"],
        "links": ["movieId,imdbId,tmdbId", "1,0000001,1"],
    }
    for table, lines in rows.items():
        (landing / settings.BRONZE_FILES[table]).write_text("\n".join(lines) + "\n")
    store = TableStore(spark, str(root / "store"))
    bootstrap.bootstrap(store, str(landing))
    bootstrap.build_features(store)
    return store, len(ratings)


@pytest.fixture(scope="module")
def models(built):
    store, _ = built
    return {v: training.train_variant(store, v, PARAMS) for v in (GENERAL, NOKIDS)}


def test_silver_and_gold_tables(built):
    store, landed = built
    counts = {t: store.count(t) for t in (settings.RATINGS_CLEAN, settings.RATINGS_HOLDOUT, settings.MOVIES_EXPLODED)}
    assert counts[settings.RATINGS_CLEAN] + counts[settings.RATINGS_HOLDOUT] == landed - 1
    assert counts[settings.MOVIES_EXPLODED] == 30
    assert counts[settings.RATINGS_CLEAN] == pytest.approx(0.8 * (landed - 1), abs=2)
    train, holdout = training.read_split_boundaries(store)
    assert train < holdout
    assert store.count(settings.USER_PROFILE_FEATURES) == 60


def test_boundaries_must_exist(spark, tmp_path):
    with pytest.raises(RuntimeError, match="missing or empty"):
        training.read_split_boundaries(TableStore(spark, str(tmp_path)))


def test_model_learns_and_survives_saving(built, models, tmp_path):
    store, _ = built
    model, per_genre, overall = models[GENERAL]
    assert {r.genre for r in per_genre.collect()} == set(GENRES)
    assert overall.first().rmse_overall < 1.5
    model.save(store.spark, str(tmp_path / "model"))
    again = MultiOutputModel.load(store.spark, str(tmp_path / "model"), GENRES)
    user_genre, profiles = store.read(settings.USER_GENRE_FEATURES), store.read(settings.USER_PROFILE_FEATURES)
    from palate.operators.model import batch_score

    assert rows_of(batch_score(user_genre, profiles, again)) == rows_of(batch_score(user_genre, profiles, model))


def test_validation_promotion_and_scoring(built, models):
    store, _ = built
    candidates = {GENERAL: (models[GENERAL][0], models[GENERAL][0]), NOKIDS: (models[NOKIDS][0], None)}
    report = training.validate(store, candidates)
    found = {(r.variant, r.check_name): r for r in report.collect()}
    assert len(found) == 12
    assert found["general", "champion"].passed is True
    assert found["nokids", "champion"].passed is None
    assert found["general", "rmse"].passed is True
    failed = report.withColumn("passed", F.lit(False))
    # Metrics are kept as tables, and nothing that was staged for them is left.
    assert {r.variant for r in store.read(settings.HOLDOUT_METADATA).collect()} == {"general", "nokids"}
    assert store.read(settings.GENRE_METRICS).count() == len(GENRES) + len(GENRES[:2])
    assert store.read(f"{settings.TRAINING_METRICS}_general").count() == len(GENRES) + 1
    left = child_names(store.spark, scratch._application_dir(store.spark))
    assert not [n for n in left if n.startswith(("test-", "validation-cells", "evaluation-cells", "updates"))]

    with pytest.raises(RuntimeError, match="nothing is promoted"):
        training.require_promotion(failed)
    training.require_promotion(report.withColumn("passed", F.lit(True)))

    assert serving.score_variant(store, GENERAL, models[GENERAL][0]) == 60
    scores = store.read(settings.SCORES_DAILY)
    assert scores.columns == ["userId", *GENRES]
    best = {r.userId: max(GENRES, key=lambda g: r[g]) for r in scores.collect()}
    assert sum(best[u] == GENRES[u % 3] for u in range(60)) > 45
    serving.score_variant(store, NOKIDS, models[NOKIDS][0])
    assert store.read(settings.SCORES_DAILY_NOKIDS).columns == ["userId", *GENRES[:2]]


def test_replay_moves_every_rating_once_and_drift_is_logged(built):
    store, landed = built
    log = serving.drift_check(store, "test")
    assert [(r.feature_psi, r.drift_detected) for r in log.collect()] == [("{}", False)]

    holdout = store.read(settings.RATINGS_HOLDOUT)
    oldest = holdout.agg(F.min(F.unix_seconds("timestamp"))).first()[0]
    before = store.count(settings.RATINGS_CLEAN)
    until = serving.simulate_day(store, days=30)
    assert until == oldest + 30 * DAY
    moved = holdout.where(F.unix_seconds("timestamp") <= until).count()
    assert store.count(settings.RATINGS_CLEAN) == before + moved

    # A run that stopped before it noted its progress is repeated without adding rows twice.
    store.overwrite(settings.HOLDOUT_PROGRESS, store.read(settings.HOLDOUT_PROGRESS).limit(0))
    assert replay.advance(store, days=30) == until
    assert store.count(settings.RATINGS_CLEAN) == before + moved

    last = until
    while (moved_to := replay.advance(store, days=60)) != replay.NO_HOLDOUT_DATA:
        last = moved_to
    # Features lag behind, as after a crash between the two steps: first they catch up, and no window is moved.
    versions = store._versions(settings.USER_GENRE_FEATURES)
    assert serving.simulate_day(store) == last
    assert store._versions(settings.USER_GENRE_FEATURES) != versions
    assert serving.simulate_day(store) == replay.NO_HOLDOUT_DATA
    assert store.count(settings.RATINGS_CLEAN) == landed - 1
    assert replay.remaining_holdout(store).count() == 0

    bootstrap.build_features(store, fraction=0.5)
    log = serving.drift_check(store, "test")
    assert log.count() == 2
    latest = log.orderBy(F.desc("timestamp")).first()
    assert set(json.loads(latest.feature_psi)) == set(settings.GENRE_FEATURES)
    assert latest.catalog == "test"


def test_window_end_is_included(frames):
    holdout = frames.ratings((1, 1, 3.0, 100), (2, 1, 3.0, 100 + DAY), (3, 1, 3.0, 101 + DAY))
    moved, kept = replay.advance_window(holdout, days=1)
    assert rows_of(moved, "userId") == [(1,), (2,)]
    assert rows_of(kept, "userId") == [(3,)]
    assert [df.count() for df in replay.advance_window(frames.ratings(), days=1)] == [0, 0]
