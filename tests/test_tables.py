import pytest

from palate.operators.quality import table_counts, table_problems
from palate.schemas import BRONZE
from palate.settings import BRONZE_FILES
from palate.sources import csv
from palate.sources.files import child_names
from palate.sources.scratch import new_dir, stage, staged
from palate.sources.tables import merge_rows
from tests.conftest import rows_of

# Small landing files, quoting and leading zeros included.
LANDING = {
    "ratings": "userId,movieId,rating,timestamp\n1,1,4.0,964982703\n1,2,3.5,964982931\n2,1,,964982931\n",
    "movies": 'movieId,title,genres\n1,"Good, the Bad, The",Action|Western\n2,"A ""quoted"" name",(no genres listed)\n',
    "tags": "userId,movieId,tag,timestamp\n1,1,slow,1445714994\n",
    "genome_scores": "movieId,tagId,relevance\n1,1,0.25\n",
    "genome_tags": "tagId,tag\n1,slow\n",
    "links": "movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,\n",
}


@pytest.fixture
def landing(tmp_path):
    for table, text in LANDING.items():
        (tmp_path / BRONZE_FILES[table]).write_text(text)
    return str(tmp_path)


def test_ingest_all_keeps_types_and_text(store, landing):
    tables = csv.ingest_all(store, landing)
    assert set(tables) == set(BRONZE)
    assert rows_of(tables["ratings"]) == [(1, 1, 4.0, 964982703), (1, 2, 3.5, 964982931), (2, 1, None, 964982931)]
    assert rows_of(tables["movies"], "title") == [('A "quoted" name',), ("Good, the Bad, The",)]
    assert rows_of(tables["links"]) == [(1, "0114709", 862), (2, "0113497", None)]
    assert tables["ratings"].dtypes[0] == ("userId", "bigint")


def test_ingest_replaces_and_missing_skips(store, landing):
    csv.ingest_csv(store, f"{landing}/ratings.csv", "bronze.ratings", BRONZE["ratings"])
    first = csv.ingest_missing(store, landing)
    assert first["ratings"] == "skipped" and set(first.values()) == {"skipped", "loaded"}
    assert set(csv.ingest_missing(store, landing).values()) == {"skipped"}
    csv.ingest_all(store, landing)
    assert store.count("bronze.ratings") == 3


def test_header_must_match(store, tmp_path):
    (tmp_path / "bad.csv").write_text("movieId,userId,rating,timestamp\n1,2,3.0,4\n")
    with pytest.raises(Exception, match="CSV header"):
        csv.ingest_csv(store, str(tmp_path / "bad.csv"), "bronze.ratings", BRONZE["ratings"])
    assert not store.exists("bronze.ratings")


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), "userId BIGINT, genre STRING, v DOUBLE")


def test_versions_let_a_table_be_rebuilt_from_itself(spark, store):
    store.overwrite("silver.t", numbers(spark, (1, "A", 1.0), (2, "A", 2.0)))
    old = store.read("silver.t")
    store.overwrite("silver.t", old.where("v > 1"))
    assert rows_of(store.read("silver.t"), "userId") == [(2,)]
    assert rows_of(old, "userId") == [(1,), (2,)]
    store.expire("silver.t")
    assert rows_of(store.read("silver.t"), "userId") == [(2,)]
    with pytest.raises(Exception):
        old.collect()


def test_an_incomplete_version_is_ignored(spark, store):
    store.overwrite("silver.t", numbers(spark, (1, "A", 1.0)))
    broken = numbers(spark, (9, "Z", 9.0))
    broken.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store.root}/silver/t/v000002")
    assert rows_of(store.read("silver.t"), "userId") == [(1,)]
    store.overwrite("silver.t", numbers(spark, (3, "A", 1.0)))
    assert rows_of(store.read("silver.t"), "userId") == [(3,)]


def test_reading_a_missing_table(store):
    assert not store.exists("silver.none")
    with pytest.raises(LookupError):
        store.read("silver.none")


def test_append_creates_then_adds(spark, store):
    store.append("inference.log", numbers(spark, (1, "A", 1.0)))
    store.append("inference.log", numbers(spark, (2, "A", 1.0)))
    assert rows_of(store.read("inference.log"), "userId") == [(1,), (2,)]


def test_slices_are_idempotent(spark, store):
    store.overwrite_sliced("silver.s", numbers(spark, (1, "A", 1.0)))
    for _ in range(2):
        store.write_slice("silver.s", numbers(spark, (2, "A", 2.0)), 77)
    assert rows_of(store.read("silver.s")) == [(1, "A", 1.0), (2, "A", 2.0)]


def test_upsert_creates_replaces_inserts_and_keeps(spark, store):
    keys = ["userId", "genre"]
    store.upsert("gold.f", numbers(spark, (1, "A", 1.0), (1, "B", 2.0)), keys)
    updates = numbers(spark, (1, "B", 9.0), (2, "A", 3.0))
    for _ in range(2):
        store.upsert("gold.f", updates, keys)
        assert rows_of(store.read("gold.f")) == [(1, "A", 1.0), (1, "B", 9.0), (2, "A", 3.0)]


def test_merge_aligns_columns_by_name(spark):
    target = numbers(spark, (1, "A", 1.0)).select("v", "genre", "userId")
    assert rows_of(merge_rows(target, numbers(spark, (2, "A", 2.0)), ["userId"])) == [(1, "A", 1.0), (2, "A", 2.0)]


def test_counts_and_problems(spark):
    tables = {"a": numbers(spark, (1, "A", 1.0)), "b": numbers(spark), "c": numbers(spark, (1, "A", 1.0))}
    assert rows_of(table_counts(tables)) == [("a", 1), ("b", 0), ("c", 1)]
    assert table_problems(tables, {"a": ["userId"], "c": ["label", "v"]}) == {"b": "empty", "c": "missing columns label"}


def test_staged_frames_live_in_the_shared_folder(spark):
    staged = stage(numbers(spark, (1, "A", 1.0)), "probe")
    assert rows_of(staged) == [(1, "A", 1.0)]
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or new_dir(spark, "x").startswith(configured)
    assert new_dir(spark, "x") != new_dir(spark, "x")


def test_a_staged_block_leaves_nothing_behind(spark):
    with staged(numbers(spark, (1, "A", 1.0)), "block") as copy:
        assert rows_of(copy) == [(1, "A", 1.0)]
    home = new_dir(spark, "x").rsplit("/", 1)[0]
    assert not [name for name in child_names(spark, home) if name.startswith("block-")]
