"""Exact k-means on whole numbers with a vector-approximation file.

Components become whole numbers ``floor(scale * x)``. Centroids start as the vectors of smallest hash; a round assigns
every vector to its nearest centroid and moves each centroid to the floor of its vectors' mean.

* **Approximations.** Each dimension is cut at its quantiles into ``2 ** bits`` cells, and a vector's cells are stored
  beside it as one byte a dimension. Lookup tables give the middle and half the width of a cell, and with them, for
  every centroid, the interval that its distance lies in. Intervals are taken of the distance beyond that of the
  centroid nearest to the middles: what all centroids share cancels, which leaves them much narrower.
* **Rounds move sums, not vectors.** A vector whose intervals single out the same centroid under the round's centroids
  and under those before adds nothing to the change of the sums. The first scan of a round reads cells alone and
  counts, per part of the table, the vectors left; the second reads the full vectors of the parts that have any, and
  compares exact distances for just these vectors. The first round and the last, which returns distances, read all.
* **Parts.** The table is partitioned by first centroid and by how far the second nearest was, so vectors deep inside
  a cluster share parts, and such parts drop out of the rounds.

A round depends on nothing but the staged table and two sets of centroids, so a lost executor costs its tasks alone.
Nothing is joined or collected but quantiles, seeds, part counts and sums, bounded by ``k``, dimensions and ``bits``;
the one shuffle of vectors is dealt by part and split by size.

Defined results: vectors that are null, of another length, or hold a null or a number that is not finite take no part;
repeated rows are separate vectors; a row without ``vec_id`` is a vector, but no seed, and without any seed the result
is empty; ties of seeds go to the smaller vector, so equal rows may be two seeds, of which the second stays empty;
components from ``2 ** 53`` on and distances or sums beyond 64 bits fail the job; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.common import map_batches, stage
from palate.sources.files import write_parquet
from palate.sources.scratch import new_dir

_LEVELS = 32
_EXACT = 1 << 53


@dataclass(frozen=True)
class Settings:
    k: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    bits: int = 6
    salt: str = "3:"


def kept(vectors: DataFrame, settings: Settings) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part."""
    real = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where((F.size("embedding") == settings.dims) & real).select("vec_id", "embedding")


def _whole(embeddings: np.ndarray, scale: int) -> np.ndarray:
    numbers = np.floor(embeddings.astype(float) * scale)
    if numbers.size and not np.abs(numbers).max() < _EXACT:
        raise ValueError(f"a component times {scale} reaches 2**53")
    return numbers


def _seeds(vectors: DataFrame, n: int, settings: Settings) -> list[list[int]]:
    """The ``k`` vectors of smallest hash; a bound on hashes keeps what tasks send small."""
    digest = F.sha2(F.concat(F.lit(settings.salt), F.col("vec_id").cast("string")), 256)
    hashed = vectors.where(F.col("vec_id").isNotNull()).select(digest.alias("digest"), "embedding")
    share = 64 * settings.k / max(n, 1)
    while True:
        few = hashed.where(F.col("digest") < f"{int(share * 2**32):08x}") if share < 1 else hashed
        rows = few.orderBy("digest", "embedding").limit(settings.k).collect()
        if len(rows) == settings.k or share >= 1:
            embeddings = np.array([row["embedding"] for row in rows], float).reshape(len(rows), settings.dims)
            return [[int(x) for x in row] for row in _whole(embeddings, settings.scale)]
        share *= 16


@dataclass(frozen=True)
class Cells:
    """Inner bounds of the cells of each dimension, and the least and greatest number there."""

    bounds: list[np.ndarray]
    ends: list[tuple[float, float]]

    def of(self, numbers: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(own, column, side="right") for own, column in zip(self.bounds, numbers.T, strict=True)]
        return np.stack(found, axis=1).astype(np.uint8)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Middle and half width by dimension and cell."""
        most = max(len(own) for own in self.bounds) + 1
        middle, half = np.zeros((len(self.bounds), most)), np.zeros((len(self.bounds), most))
        for d, (own, (least, greatest)) in enumerate(zip(self.bounds, self.ends, strict=True)):
            low, high = np.append(least, own), np.append(own - 1, greatest)
            middle[d, : len(low)], half[d, : len(low)] = (low + high) / 2, np.maximum(high - low, 0) / 2
        return middle, half


def _cells(vectors: DataFrame, settings: Settings) -> tuple[int, Cells | None]:
    """How many vectors there are, and cells that hold about as many numbers each."""
    wanted = [i / 2**settings.bits for i in range(1, 2**settings.bits)]
    columns = [F.col("embedding")[d].cast("double") for d in range(settings.dims)]
    row = vectors.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.percentile_approx(c, wanted, 8 * 2**settings.bits) for c in columns]).alias("cuts"),
        F.array(*[F.struct(F.min(c), F.max(c)) for c in columns]).alias("ends"),
    ).first()
    if not row["n"]:
        return 0, None
    ends = _whole(np.array([tuple(pair) for pair in row["ends"]]), settings.scale)
    cuts = [np.unique(_whole(np.array(own), settings.scale)) for own in row["cuts"]]
    return row["n"], Cells([own[own > least] for own, (least, _) in zip(cuts, ends, strict=True)], [*map(tuple, ends)])


def nearest(numbers: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the squared distance to it and that to the second nearest, all exact."""
    centers = np.array(centroids, dtype=float)
    most = np.abs(numbers).max(initial=0) + np.abs(centers).max()
    if 4 * numbers.shape[1] * most * most < _EXACT:
        square = (numbers**2).sum(axis=1)[:, None] - 2 * numbers @ centers.T + (centers**2).sum(axis=1)
        square = square.astype(np.int64)
    else:
        exact = np.array([[int(x) for x in row] for row in numbers], dtype=object).reshape(numbers.shape)
        square = np.stack([((exact - np.array(c, dtype=object)) ** 2).sum(axis=1) for c in centroids], axis=1)
    first = np.array([int(i) for i in square.argmin(axis=1)], np.int64)
    rows = np.arange(len(first))
    second = np.sort(square, axis=1)[:, min(1, square.shape[1] - 1)]
    return first, square[rows, first], second


def singled_out(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray], centroids: list[list[int]]) -> np.ndarray:
    """The nearest centroid of each row where its cells tell, else -1."""
    dims = np.arange(cells.shape[1])
    middle, half = tables[0][dims, cells], tables[1][dims, cells]
    centers = np.array(centroids, dtype=float)
    squares = (centers**2).sum(axis=1)
    closest = (squares - 2 * middle @ centers.T).argmin(axis=1)
    length = (middle**2).sum(axis=1)
    found = np.full(len(cells), -1, np.int64)
    for i in np.unique(closest):
        rows = np.flatnonzero(closest == i)
        apart = centers - centers[i]
        beyond = (squares - squares[i]) - 2 * middle[rows] @ apart.T
        slack = 2 * half[rows] @ np.abs(apart).T
        # Far more than rounding can amount to.
        slack += 1e-9 * (length[rows, None] + squares + squares[i] + slack)
        alone = (beyond > slack) | (np.arange(len(centers)) == i)
        found[rows[alone.all(axis=1)]] = i
    return found


_PLACED = pa.schema([("vec_id", pa.int64()), ("cells", pa.binary()), ("vector", pa.binary()), ("part", pa.int32())])


def _place(vectors: DataFrame, cells: Cells, centroids: list[list[int]], settings: Settings) -> DataFrame:
    """Vectors and their cells, written by first centroid and margin."""

    def run(parts: Iterator[dict[str, pa.Array]]) -> Iterator[dict]:
        for part in parts:
            embeddings = part["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(-1, settings.dims)
            numbers = _whole(embeddings, settings.scale)
            first, near, second = nearest(numbers, centroids)
            margin = [1 - a / b if b else 0.0 for a, b in zip(near.tolist(), second.tolist(), strict=True)]
            level = np.minimum(np.array(margin) * _LEVELS, _LEVELS - 1).astype(np.int64)
            yield {
                "vec_id": part["vec_id"],
                "cells": [row.tobytes() for row in cells.of(numbers)],
                "vector": [row.tobytes() for row in numbers.astype("<f8")],
                "part": first * _LEVELS + level,
            }

    placed = map_batches(vectors, ["vec_id", "embedding"], run, _PLACED, rows=4096, arrow=True)
    path = new_dir(vectors.sparkSession, "va-file")
    write_parquet(placed.hint("rebalance", "part"), path, by=["part"])
    return vectors.sparkSession.read.schema(placed.schema).parquet(path)


def _numbers(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dims)


def _bytes(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, dims)


def _left(part: dict, tables, before, now, dims: int) -> np.ndarray:
    """Rows that their cells do not assign to the same centroid before and now."""
    cells = _bytes(part["cells"], dims)
    found = singled_out(cells, tables, now)
    return (found < 0) | (found != singled_out(cells, tables, before))


def _parts_left(placed: DataFrame, tables, before, now, settings: Settings) -> list[int]:
    """Parts that hold vectors of which cells alone do not tell enough."""

    def run(batches: Iterator[dict[str, pa.Array]]) -> Iterator[dict]:
        for batch in batches:
            left = _left(batch, tables, before, now, settings.dims)
            own = np.unique(batch["part"].to_numpy()[left])
            if len(own):
                yield {"part": own}

    schema = pa.schema([("part", pa.int32())])
    found = map_batches(placed, ["cells", "part"], run, schema, rows=4096, arrow=True)
    return sorted(row["part"] for row in found.distinct().collect())


_SUMS = pa.schema([("cluster", pa.int32()), ("sums", pa.list_(pa.decimal128(38, 0)))])
Sums = dict[int, list[int]]


def _add(held: Sums, numbers: np.ndarray, clusters: np.ndarray, sign: int) -> None:
    """Add rows and their number, as a last component, to the sums of their clusters."""
    safe = np.abs(numbers).max(initial=0) * len(numbers) < _EXACT
    for cluster in np.unique(clusters).tolist():
        own = numbers[clusters == cluster]
        total = own.sum(axis=0).tolist() if safe else map(sum, zip(*(map(int, row) for row in own.tolist())))
        new = [*map(int, total), len(own)]
        old = held.get(cluster, [0] * len(new))
        held[cluster] = [a + sign * b for a, b in zip(old, new, strict=True)]


def _total(partial: DataFrame) -> Sums:
    rows = (
        partial.select("cluster", F.posexplode("sums").alias("at", "part"))
        .groupBy("cluster", "at")
        .agg(F.sum("part").alias("total"))
        .collect()
    )
    found: Sums = {}
    for row in sorted(rows, key=lambda r: r["at"]):
        found.setdefault(row["cluster"], []).append(int(row["total"]))
    return found


def _sums(placed: DataFrame, centroids, settings: Settings) -> Sums:
    """Sums of all vectors by nearest centroid."""

    def run(parts: Iterator[dict[str, pa.Array]]) -> Iterator[dict]:
        held: Sums = {}
        for part in parts:
            numbers = _numbers(part["vector"], settings.dims)
            _add(held, numbers, nearest(numbers, centroids)[0], 1)
        if held:
            yield {"cluster": list(held), "sums": [[*map(Decimal, own)] for own in held.values()]}

    return _total(map_batches(placed, ["vector"], run, _SUMS, rows=4096, arrow=True))


def _changes(placed: DataFrame, tables, before, now, settings: Settings) -> Sums:
    """What the sums by nearest centroid gain from ``before`` to ``now``."""
    parts = _parts_left(placed, tables, before, now, settings)
    if not parts:
        return {}

    def run(batches: Iterator[dict[str, pa.Array]]) -> Iterator[dict]:
        held: Sums = {}
        for batch in batches:
            left = _left(batch, tables, before, now, settings.dims)
            numbers = _numbers(batch["vector"].filter(pa.array(left)), settings.dims)
            old, new = nearest(numbers, before)[0], nearest(numbers, now)[0]
            moved = old != new
            _add(held, numbers[moved], old[moved], -1)
            _add(held, numbers[moved], new[moved], 1)
        if held:
            yield {"cluster": list(held), "sums": [[*map(Decimal, own)] for own in held.values()]}

    fetched = placed.where(F.col("part").isin(parts))
    return _total(map_batches(fetched, ["cells", "vector"], run, _SUMS, rows=4096, arrow=True))


def _means(sums: Sums, centroids: list[list[int]]) -> list[list[int]]:
    """Floors of the means; a centroid without vectors stays."""
    return [
        [total // own[-1] for total in own[:-1]] if (own := sums.get(i)) and own[-1] else centroid
        for i, centroid in enumerate(centroids)
    ]


_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _assign(placed: DataFrame, centroids, settings: Settings) -> DataFrame:
    def run(parts: Iterator[dict[str, pa.Array]]) -> Iterator[dict]:
        for part in parts:
            cluster, distance, _ = nearest(_numbers(part["vector"], settings.dims), centroids)
            yield {"vec_id": part["vec_id"], "cluster": cluster, "distance": distance.tolist()}

    return map_batches(placed, ["vec_id", "vector"], run, _ASSIGNED, rows=4096, arrow=True)


def centroids_of(vectors: DataFrame, settings: Settings = Settings()) -> tuple[list[list[int]], DataFrame | None]:
    """The centroids after all rounds, and the staged vectors."""
    own = kept(vectors, settings)
    n, cells = _cells(own, settings)
    now = _seeds(own, n, settings) if n else []
    if not now:
        return [], None
    placed = _place(own, cells, now, settings)
    tables = cells.tables()
    sums: Sums = {}
    before = None
    for _ in range(settings.rounds):
        if before is None:
            sums = _sums(placed, now, settings)
        elif before == now:
            break
        else:
            for cluster, change in _changes(placed, tables, before, now, settings).items():
                old = sums.get(cluster, [0] * len(change))
                sums[cluster] = [a + b for a, b in zip(old, change, strict=True)]
        before, now = now, _means(sums, now)
    return now, placed


def cluster(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per vector ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    centroids, placed = centroids_of(vectors, settings)
    if placed is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    assigned = stage(_assign(placed, centroids, settings), "clusters")
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    inertia = {row["cluster"]: int(row["total"]) for row in per_cluster.collect()}
    if sum(inertia.values()) >= 1 << 63:
        raise OverflowError("the sum of distances does not fit 64 bits")
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list) -> Column:
        return F.array(*map(F.lit, values))[F.col("cluster")]

    return assigned.select(
        "vec_id", "cluster", "distance",
        of_cluster([inertia.get(i, 0) for i in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(names).alias("centroid_sha256"),
    )


def oracle_sql(settings: Settings = Settings()) -> str:
    """The same in SQL: all vectors in long form, one distance per vector, centroid and round."""

    def assign(i: int) -> str:
        return f"""dist{i} AS MATERIALIZED (
  SELECT row, k, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM v JOIN c{i} c USING (d) GROUP BY row, k
), a{i} AS MATERIALIZED (
  SELECT row, k, distance FROM dist{i} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, k) = 1
)"""

    def move(i: int) -> str:
        return f"""c{i} AS MATERIALIZED (
  SELECT k, d, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{i - 1} c LEFT JOIN (
    SELECT k, d, sum(x) AS s, count(*) AS n FROM a{i - 1} JOIN v USING (row) GROUP BY k, d
  ) USING (k, d)
)"""

    steps = [assign(0)]
    for i in range(1, settings.rounds + 1):
        steps += [move(i), assign(i)]
    last = settings.rounds
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding, sha256('{settings.salt}' || vec_id) AS hash
  FROM embeddings
  WHERE len(embedding) = {settings.dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {settings.dims}
), v AS MATERIALIZED (
  SELECT row, unnest(range({settings.dims})) AS d,
         CAST(floor({settings.scale} * CAST(unnest(embedding) AS DOUBLE)) AS HUGEINT) AS x FROM kept
), seeds AS MATERIALIZED (
  SELECT row, row_number() OVER (ORDER BY hash, embedding) - 1 AS k FROM kept WHERE vec_id IS NOT NULL
  QUALIFY k < {settings.k}
), c0 AS MATERIALIZED (SELECT k, d, x FROM seeds JOIN v USING (row)),
{", ".join(steps)},
names AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (row) JOIN names USING (k)
"""
