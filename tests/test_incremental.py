import pytest
from pyspark.sql import functions as F

from palate import settings
from palate.operators.features import user_genre_features, user_profile_features
from palate.plans import bootstrap, incremental
from palate.settings import SECONDS_PER_DAY as DAY
from palate.streaming import replay


@pytest.fixture
def filled(store, spark):
    ratings = [(u, m, (u * m) % 10 / 2 + 0.5, (u * 37 + m * 11) % 200 * DAY + u) for u in range(20) for m in range(15)]
    store.overwrite("bronze.ratings", spark.createDataFrame(ratings, "userId long, movieId long, rating double, timestamp long"))
    movies = [(m, f"m{m}", "(no genres listed)" if m == 3 else ("A|B", "B", "C")[m % 3]) for m in range(15)]
    store.overwrite("bronze.movies", spark.createDataFrame(movies, "movieId long, title string, genres string"))
    tags = spark.createDataFrame([(1, 1, "x", 5), (1, 4, "y", 5), (2, 2, "x", 5)], "userId long, movieId long, tag string, timestamp long")
    store.overwrite("bronze.tags", tags)
    store.overwrite("bronze.genome_scores", spark.createDataFrame([(m, 1, m / 20) for m in range(9)], "movieId long, tagId long, relevance double"))
    store.overwrite("bronze.genome_tags", spark.createDataFrame([(1, "one")], "tagId long, tag string"))
    bootstrap.build_silver(store, 0.5)
    return store


def tables(user_genre, profiles):
    def rounded(df):
        columns = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
        return sorted(map(tuple, df.select(*columns).collect()), key=repr)

    return rounded(user_genre), rounded(profiles)


def from_scratch(store):
    ratings, exploded = store.read(settings.RATINGS_CLEAN), store.read(settings.MOVIES_EXPLODED)
    return tables(
        user_genre_features(ratings, exploded, store.read(settings.GENOME_AGG), store.read("bronze.tags")),
        user_profile_features(ratings, exploded),
    )


def test_three_windows_equal_a_rebuild(filled, monkeypatch):
    incremental.rebuild(filled)
    assert tables(*incremental.features(filled)) == from_scratch(filled)
    opened = []
    read, read_slice = filled.read, filled.read_slice
    monkeypatch.setattr(filled, "read", lambda name: opened.append(name) or read(name))
    monkeypatch.setattr(filled, "read_slice", lambda name, i: opened.append((name, i)) or read_slice(name, i))
    for day in range(3):
        until = replay.advance(filled, days=30)
        opened.clear()
        assert incremental.absorb(filled) == [until]
        incremental.features(filled)
        # Of the clean ratings only the new slice is read.
        assert settings.RATINGS_CLEAN not in opened and (settings.RATINGS_CLEAN, until) in opened
        if day == 1:
            incremental.compact(filled)
            assert len(filled.slices(settings.USER_STATE)) == 1
    monkeypatch.undo()
    incremental.simulate_day(filled, days=30)
    stored = [filled.read(name) for name in (settings.USER_GENRE_FEATURES, settings.USER_PROFILE_FEATURES)]
    assert tables(*stored) == from_scratch(filled)


def test_a_repeated_run_adds_nothing_twice(filled):
    incremental.simulate_day(filled, days=30)
    assert incremental.absorb(filled) == []
    replay.advance(filled, days=30)
    # A run that stopped between the two tables is finished by the next.
    last = filled.slices(settings.RATINGS_CLEAN)[-1]
    sums = incremental._sums_of(filled, filled.read_slice(settings.RATINGS_CLEAN, last))
    filled.write_slice(settings.USER_STATE, sums[settings.USER_STATE], last)
    assert incremental.absorb(filled) == [last] and incremental.absorb(filled) == []
    incremental.compact(filled)
    incremental.compact(filled)
    assert incremental.absorb(filled) == []
    assert tables(*incremental.features(filled)) == from_scratch(filled)


def test_a_slice_is_read_alone(filled):
    until = replay.advance(filled, days=30)
    one = filled.read_slice(settings.RATINGS_CLEAN, until)
    assert all(f"slice={until}" in path for path in one.inputFiles()) or "PartitionFilters: [isnotnull(slice" in (
        one._jdf.queryExecution().executedPlan().toString()
    )
    with pytest.raises(LookupError):
        filled.read_slice(settings.RATINGS_CLEAN, -1)
    assert filled.slices("no.table") == []


def test_tags_are_counted_when_sums_start_anew(filled, monkeypatch):
    incremental.rebuild(filled)
    opened, read = [], filled.read
    monkeypatch.setattr(filled, "read", lambda name: opened.append(name) or read(name))
    incremental.simulate_day(filled, days=30)
    assert settings.USER_TAG_STATE in opened and "bronze.tags" not in opened
    monkeypatch.undo()
    stored = [filled.read(name) for name in (settings.USER_GENRE_FEATURES, settings.USER_PROFILE_FEATURES)]
    assert tables(*stored) == from_scratch(filled)


def test_both_feature_tables_are_built_from_one_reading(filled, monkeypatch):
    opened, read = [], filled.read
    monkeypatch.setattr(filled, "read", lambda name: opened.append(name) or read(name))
    bootstrap.build_features(filled)
    # Once for the features, once for the time boundaries.
    assert opened.count(settings.RATINGS_CLEAN) == 2
    monkeypatch.undo()
    stored = [filled.read(name) for name in (settings.USER_GENRE_FEATURES, settings.USER_PROFILE_FEATURES)]
    assert tables(*stored) == from_scratch(filled)
