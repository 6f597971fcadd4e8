import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from palate.sources.tables import TableStore


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


@pytest.fixture
def frames(spark):
    """Builders of small input frames."""

    class Frames:
        @staticmethod
        def raw_ratings(*rows):
            return spark.createDataFrame(
                list(rows), "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT"
            )

        @classmethod
        def ratings(cls, *rows):
            return cls.raw_ratings(*rows).withColumn("timestamp", F.timestamp_seconds("timestamp"))

        @staticmethod
        def movies(*rows):
            return spark.createDataFrame(list(rows), "movieId BIGINT, title STRING, genres STRING")

        @staticmethod
        def exploded(*pairs):
            rows = [(movie, f"m{movie}", genre) for movie, genre in pairs]
            return spark.createDataFrame(rows, "movieId BIGINT, title STRING, genre STRING")

        @staticmethod
        def genome(*rows):
            return spark.createDataFrame(list(rows), "movieId BIGINT, genre STRING, avg_genome_relevance DOUBLE")

        @staticmethod
        def tags(*rows):
            return spark.createDataFrame(list(rows), "userId BIGINT, movieId BIGINT, tag STRING, timestamp BIGINT")

        @staticmethod
        def cells(*rows):
            return spark.createDataFrame(list(rows), "userId BIGINT, genre STRING, y DOUBLE, p DOUBLE")

    return Frames


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
