"""Exact top-k by inner product: a Voronoi kNN join of query vectors against all vectors.

Vectors are whole numbers after ``floor(scale * x)``. Pivots are a bounded sample of them; every vector belongs to
its nearest pivot's cell, cells are cut into blocks of bounded size, and a block's summary is its pivot, radius and
count. For a query block with pivot p and radius r, and a data block with pivot s and radius t, every score lies in
``p.s -+ (|p| t + |s| r + r t)``. The lower bounds of enough data blocks give each query block a score that its k-th
neighbour reaches at least; a data block whose upper bound stays below it is not joined to the query block. Query
blocks, the smaller side, are replicated to the data blocks they need, each pair is solved by one matrix product, and
a task keeps the k best per query over the pairs it sees before they are merged.

Only pivots and block summaries reach the driver. Pivots are bounded by ``pivots``; of block pairs, blocks grow with
the data as any exact join in high dimension needs, so bounds are computed in the cluster, block by block.

Defined results: vectors that are null or hold a null or a number that is not finite take no part; vectors of
different length are not compared; an empty vector scores 0; every row is a candidate, so equal rows are listed as
often as they are there, and rows of one ``vec_id`` never find each other; query rows of one ``vec_id`` share one list,
of what any of them finds; components are exact, and those beyond 2**62 or a listed score beyond 64 bits fail the job;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import map_batches, stage


@dataclass(frozen=True)
class Settings:
    k: int = 20
    scale: int = 64
    every: int = 20
    pivots: int = 16
    block: int = 1024
    query_block: int = 1024
    seed: int = 3


_MOST = 2.0**62


def whole_numbers(vectors: DataFrame, settings: Settings) -> DataFrame:
    """``vec_id, vector`` of the vectors that take part."""
    real = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * settings.scale
        return F.when(F.abs(scaled) < _MOST, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component reaches 2**62")))

    takes_part = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & real
    return vectors.where(takes_part).select("vec_id", F.transform("embedding", whole).alias("vector"))


def _pivots(vectors: DataFrame, settings: Settings) -> dict[int, np.ndarray]:
    """A bounded sample of vectors, by length."""
    rows = (
        vectors.select("vector")
        .orderBy(F.xxhash64("vec_id", F.lit(settings.seed)), "vec_id", "vector")
        .limit(settings.pivots)
        .collect()
    )
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(len(row["vector"]), []).append(row["vector"])
    return {n: np.unique(np.array(own, float), axis=0) for n, own in found.items()}


_CELLS = pa.schema(
    [("vec_id", pa.int64()), ("vector", pa.binary()), ("size", pa.int32()), ("cell", pa.int32()), ("far", pa.float64()), ("copies", pa.int64())]
)


def _cells(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Each vector with its length, its nearest pivot and the distance to it."""

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            for size in sorted({len(v) for v in part["vector"]}):
                chosen = [i for i, v in enumerate(part["vector"]) if len(v) == size]
                rows = np.array([part["vector"][i] for i in chosen], float).reshape(len(chosen), size)
                own = pivots.get(size, np.zeros((1, size)))
                square = ((rows[:, None, :] - own[None]) ** 2).sum(axis=2) if size else np.zeros((len(rows), len(own)))
                cell = square.argmin(axis=1)
                yield {
                    "vec_id": [part["vec_id"][i] for i in chosen],
                    "vector": [np.array(part["vector"][i], "<i8").tobytes() for i in chosen],
                    "size": [size] * len(chosen),
                    "cell": cell,
                    "far": np.sqrt(square[np.arange(len(rows)), cell]),
                    "copies": np.ones(len(chosen), np.int64),
                }

    return map_batches(vectors, ["vec_id", "vector"], run, _CELLS, rows=512)


def _cut(cells: DataFrame, rows: int, name: str) -> DataFrame:
    """Cells cut by hash into blocks of about ``rows`` vectors; one row per block with all of them packed."""
    sizes = cells.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / rows).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", "vector"), "parts")
    return (
        cells.join(F.broadcast(sizes), ["size", "cell"])
        .groupBy("size", "cell", part.alias("part"))
        .agg(
            F.max("far").alias("radius"),
            F.count(F.lit(1)).alias("n"),
            F.collect_list(F.struct("vec_id", "vector", "copies")).alias("rows"),
        )
        .select(
            "size",
            *[F.col(c).alias(f"{name}_{c}") for c in ("cell", "part", "radius", "n")],
            *[F.col(f"rows.{c}").alias(f"{name}_{as_}") for c, as_ in (("vec_id", "ids"), ("vector", "values"), ("copies", "copies"))],
        )
    )


def _needed(
    queries: DataFrame, data: DataFrame, pivots: dict[int, np.ndarray], settings: Settings, own: int = 1
) -> DataFrame:
    """``size, q_cell, q_part, d_cell, d_part`` of the pairs of blocks that may hold neighbours.

    No ``vec_id`` has more than ``own`` vectors.
    """
    table = [
        (size, i, j, float(a @ b), float(np.sqrt(a @ a)), float(np.sqrt(b @ b)))
        for size, centers in pivots.items()
        for i, a in enumerate(centers)
        for j, b in enumerate(centers)
    ]
    between = queries.sparkSession.createDataFrame(
        table, "size int, q_cell int, d_cell int, dot double, q_length double, d_length double"
    )
    summaries = data.select("size", "d_cell", "d_part", "d_radius", "d_n")
    slack = (
        F.col("q_length") * F.col("d_radius")
        + F.col("d_length") * F.col("q_radius")
        + F.col("q_radius") * F.col("d_radius")
    )
    # Relative to the pivots' product this leaves room for rounding in doubles.
    margin = (F.abs("dot") + slack) * 1e-9 + 1e-6
    pairs = (
        queries.select("size", "q_cell", "q_part", "q_radius")
        .join(F.broadcast(between), ["size", "q_cell"])
        .join(summaries, ["size", "d_cell"])
        .withColumn("low", F.col("dot") - slack - margin)
        .withColumn("high", F.col("dot") + slack + margin)
    )
    # The best guaranteed vectors may include those of the query's own id.
    best_first = Window.partitionBy("size", "q_cell", "q_part").orderBy(F.desc("low"), "d_cell", "d_part")
    counted = pairs.withColumn("upto", F.sum("d_n").over(best_first.rowsBetween(Window.unboundedPreceding, 0)))
    all_pairs = Window.partitionBy("size", "q_cell", "q_part")
    floor = F.max(F.when(F.col("upto") >= settings.k + own, F.col("low"))).over(all_pairs)
    return (
        counted.withColumn("floor", floor)
        .where(F.col("floor").isNull() | (F.col("high") >= F.col("floor")))
        .select("size", "q_cell", "q_part", "d_cell", "d_part")
    )


_BEST = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products: floats hold them below 2**53, 64-bit integers below 2**63, else Python's integers."""
    if not queries.size or not data.size:
        return np.zeros((len(queries), len(data)), np.int64)
    most = int(np.abs(queries).max()) * int(np.abs(data).max()) * queries.shape[1]
    if most < 1 << 53:
        return (queries.astype(float) @ data.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return queries @ data.T
    return queries.astype(object) @ data.astype(object).T


def _merge(held: tuple | None, new: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = new if held is None else (np.concatenate([held[0], new[0]]), np.concatenate([held[1], new[1]]))
    order = np.lexsort((ids, -scores))[:k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    return scores[order], ids[order]


def _solve(pairs: DataFrame, settings: Settings) -> DataFrame:
    k = settings.k

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> dict:
            rows = list(best.items())
            counts = [len(s) for _, (s, _) in rows]
            return {
                "query_id": np.repeat(np.array([q for q, _ in rows], np.int64), counts),
                "vec_id": np.concatenate([i for _, (_, i) in rows]),
                "score": np.concatenate([s for _, (s, _) in rows]).tolist(),
            }

        for part in parts:
            for size, q_ids, q_values, q_copies, d_ids, d_values, d_copies in zip(*part.values(), strict=True):
                queries, data = (np.frombuffer(b"".join(v), "<i8").reshape(len(v), size) for v in (q_values, d_values))
                ids, copies = np.array(d_ids, np.int64), np.array(d_copies, np.int64)
                scores = _scores(queries, data)
                for i, query in enumerate(q_ids):
                    apart = ids != query
                    own, other, times = scores[i][apart], ids[apart], copies[apart] * q_copies[i]
                    if len(own) > 4 * k:
                        # Everything above the k-th score, and all ties with it.
                        near = own >= np.partition(own, len(own) - k)[len(own) - k]
                        own, other, times = own[near], other[near], times[near]
                    # More than k copies of one row cannot be among the best k.
                    times = np.minimum(times, k)
                    best[query] = _merge(best.get(query), (np.repeat(own, times), np.repeat(other, times)), k)
            if len(best) > 50_000:
                yield flush()
                best.clear()
        if best:
            yield flush()

    columns = ["size", "q_ids", "q_values", "q_copies", "d_ids", "d_values", "d_copies"]
    return map_batches(pairs, columns, run, _BEST, rows=1)


def search(vectors: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` of all other vectors for each query."""
    numbers = whole_numbers(vectors, settings)
    pivots = _pivots(numbers, settings)
    # Equal rows are one from here on, with a count.
    distinct = _cells(numbers, pivots).groupBy("vec_id", "vector").agg(
        F.sum("copies").alias("copies"), *[F.first(c).alias(c) for c in ("size", "cell", "far")]
    )
    cells = stage(distinct, "knn-cells")
    own = cells.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1
    data = stage(_cut(cells, settings.block, "d"), "knn-data")
    queries = stage(_cut(cells.where(is_query), settings.query_block, "q"), "knn-queries")
    wanted = _needed(queries, data, _known(pivots, cells), settings, own)
    pairs = wanted.join(queries.drop("q_radius", "q_n"), ["size", "q_cell", "q_part"]).join(
        data.drop("d_radius", "d_n"), ["size", "d_cell", "d_part"]
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = _solve(pairs, settings).withColumn("rank", F.row_number().over(order))
    return found.where(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")


def _known(pivots: dict[int, np.ndarray], cells: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of every length; lengths that the sample missed have one cell around zero."""
    sizes = [row["size"] for row in cells.select("size").distinct().collect()]
    return {size: pivots.get(size, np.zeros((1, size))) for size in sizes}


ORACLE_SQL = """
WITH numbers AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, list_dot_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM numbers q JOIN numbers d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""
