import pytest
from pyspark.sql import functions as F

from palate import settings
from palate.operators.silver import clean_ratings
from palate.streaming import arrivals

SCHEMA = "userId long, movieId long, rating double, timestamp long"


@pytest.fixture
def rows():
    return [(u, m, (u + m) % 10 / 2 + 0.5, 1000 * u + m) for u in range(12) for m in range(9)] + [(1, 1, 9.0, 5), (1, 2, 0.5, 10**6)]


def land(spark, landing, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_late_repeated_and_restarted_batches_give_the_batch_result(spark, store, tmp_path, rows):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    expected = rows_of(clean_ratings(spark.createDataFrame(rows, SCHEMA)))
    newer, older = [r for r in rows if r[3] >= 5000], [r for r in rows if r[3] < 5000]
    land(spark, landing, newer[:40])
    land(spark, landing, newer[40:])
    arrivals.take_up(store, landing, checkpoint, files_per_batch=1, patience=100)
    arrivals.take_up(store, landing, checkpoint)  # nothing new
    land(spark, landing, older)  # late
    land(spark, landing, newer[10:30])  # repeated
    arrivals.take_up(store, landing, checkpoint, files_per_batch=1, patience=100)
    assert rows_of(arrivals.settled(store)) == expected
    progress = store.read(settings.ARRIVAL_PROGRESS).orderBy("batch").collect()
    assert sum(p.rows for p in progress) == len(rows) + 20 and progress[0].late == 0
    assert sum(p.late for p in progress) >= len(older) - 1


def test_a_batch_that_runs_again_replaces_itself(spark, store, tmp_path, rows, monkeypatch):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    land(spark, landing, rows)
    write = store.overwrite_sliced

    def fails_after_writing(name, df, slice_id):
        write(name, df, slice_id)
        raise RuntimeError("lost")

    assert arrivals.settled(store).count() == 0
    monkeypatch.setattr(store, "overwrite_sliced", fails_after_writing)
    with pytest.raises(Exception, match="lost"):
        arrivals.take_up(store, landing, checkpoint)
    assert store.read(settings.RATINGS_ARRIVED).count() == len(rows)
    monkeypatch.undo()
    arrivals.take_up(store, landing, checkpoint)
    assert store.read(settings.RATINGS_ARRIVED).count() == len(rows)
    assert rows_of(arrivals.settled(store)) == rows_of(clean_ratings(spark.createDataFrame(rows, SCHEMA)))
    assert store.read(settings.ARRIVAL_PROGRESS).agg(F.sum("rows")).first()[0] == len(rows)
