"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.common import stage


_ROWS_PER_TASK = 500_000


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links(a, b)``; the component is its smallest id.

    Large-star and small-star steps take turns until nothing changes: each hangs the neighbours of a node on the
    smallest of them, so links never multiply and the number of turns grows with the logarithm of the graph. The
    smallest neighbour is summed before it is shuffled, and the join that brings it back may be split by key. Tasks
    are as many as the links need, which are far fewer than documents.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = _digest(edges)
    tasks = 1 + 2 * before[0] // _ROWS_PER_TASK
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).coalesce(tasks)
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.coalesce(tasks), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).coalesce(tasks)
        edges = stage(small.where("u <> v").distinct().coalesce(tasks), "links")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct().coalesce(tasks)
    )


def _digest(edges: DataFrame):
    mixed = F.xxhash64("u", "v")
    return edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.bit_xor(F.xxhash64(mixed))).first()
