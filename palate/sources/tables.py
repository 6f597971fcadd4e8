"""Named parquet tables below one root, replaced by writing a new version.

A version is a folder that counts once Spark has marked it complete, so a table can be rebuilt from
itself, readers keep the version they planned with, and a failed write changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.sources.files import child_names, delete, exists, write_parquet
from palate.sources.scratch import staged

_SLICE = "slice"


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, name: str) -> list[int]:
        names = child_names(self.spark, f"{self.root}/{name.replace('.', '/')}")
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def _version_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name.replace('.', '/')}/v{version:06d}"

    def _current(self, name: str) -> str | None:
        for version in reversed(self._versions(name)):
            path = self._version_path(name, version)
            if exists(self.spark, f"{path}/_SUCCESS"):
                return path
        return None

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read(self, name: str) -> DataFrame:
        path = self._current(name)
        if path is None:
            raise LookupError(f"table {name} does not exist below {self.root}")
        df = self.spark.read.parquet(path)
        return df.drop(_SLICE) if _SLICE in df.columns else df

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Write a new version and make it the current one; the one before stays for those who still read it."""
        write_parquet(df, self._next_path(name))
        self.expire(name, keep=2)
        return self.read(name)

    def _next_path(self, name: str) -> str:
        versions = self._versions(name)
        return self._version_path(name, versions[-1] + 1 if versions else 1)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        path = self._current(name)
        if path is None:
            return self.overwrite(name, df)
        write_parquet(df, path, "append")
        return self.read(name)

    def overwrite_sliced(self, name: str, df: DataFrame, slice_id: int = 0) -> DataFrame:
        """Like :meth:`overwrite`, for a table that later grows by :meth:`write_slice`."""
        write_parquet(df.withColumn(_SLICE, F.lit(slice_id).cast("long")), self._next_path(name), by=[_SLICE])
        self.expire(name, keep=2)
        return self.read(name)

    def write_slice(self, name: str, df: DataFrame, slice_id: int) -> DataFrame:
        """Add rows under an id; writing the same id again replaces them, so a retry adds nothing twice."""
        path = self._current(name)
        if path is None or not any(child.startswith(f"{_SLICE}=") for child in child_names(self.spark, path)):
            raise LookupError(f"{name} is not a table that grows by slices: write it with overwrite_sliced first")
        write_parquet(df, f"{path}/{_SLICE}={slice_id}", "overwrite")
        return self.read(name)

    def slices(self, name: str) -> list[int]:
        """The ids under which a table has grown, ascending; none if there is no such table."""
        path = self._current(name)
        prefix = f"{_SLICE}="
        names = child_names(self.spark, path) if path is not None else []
        return sorted(int(child.removeprefix(prefix)) for child in names if child.startswith(prefix))

    def read_slice(self, name: str, slice_id: int) -> DataFrame:
        """The rows of one id; no file of another id is opened."""
        path = self._current(name)
        if slice_id not in self.slices(name):
            raise LookupError(f"table {name} has no slice {slice_id}")
        return self.spark.read.parquet(path).where(F.col(_SLICE) == slice_id).drop(_SLICE)

    def upsert(self, name: str, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Create the table, or replace rows with equal keys, insert new ones and keep the rest.

        A merge reads the updates twice, so they are computed once and written down first.
        """
        if not self.exists(name):
            return self.overwrite(name, updates)
        with staged(updates, "updates") as rows:
            return self.overwrite(name, merge_rows(self.read(name), rows, keys))

    def count(self, name: str) -> int:
        return self.read(name).count()

    def expire(self, name: str, keep: int = 1) -> None:
        """Delete versions older than the ``keep`` newest complete ones."""
        current = self._current(name)
        if current is None:
            return
        complete = [v for v in self._versions(name) if self._version_path(name, v) <= current]
        for version in complete[: -keep or None]:
            delete(self.spark, self._version_path(name, version))


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``updates`` plus the rows of ``target`` whose key is not among them."""
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return updates.unionByName(kept.select(*updates.columns))
