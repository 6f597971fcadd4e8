"""Pack documents into sequences of fixed capacity by conflict-constrained best fit.

A document longer than the capacity is cut into full pieces and a rest. Pieces are dealt by hash to shards of a
bounded number, and each shard packs its own, largest first: its open bins are ordered by residual, and each carries
a bitmap of the sources and one of the duplicate clusters it holds. The search starts at the smallest residual that
is large enough and goes on to the next larger one until a bin without a common bit is found, so a piece gets the
tightest compatible bin, or a new one.

Texts are not shuffled, only ids, sizes and hashes; equal rows are counted before they are dealt, so neither many
copies nor a hot source meet in one shard. Shards do not depend on each other.

Defined results: a document without words gets a row with no bin; a null source conflicts with nothing, a null text
has no cluster; equal rows are packed one by one and told apart by ``copy``; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.common import WORD


@dataclass(frozen=True)
class Settings:
    """Sizes are words; a shard packs about ``shard_pieces`` pieces."""

    capacity: int = 2048
    shard_pieces: int = 2048
    seed: int = 17


def best_fit(pieces: Sequence[tuple[int, int, int]], capacity: int) -> list[int]:
    """The bin of each ``(size, source bits, cluster bits)``, in the order given; bins are numbered as they open."""
    order: list[tuple[int, int]] = []  # (residual, bin) of bins with room left
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for size, source, cluster in pieces:
        at = bisect_left(order, (size, -1))
        while at < len(order):
            own = order[at][1]
            if not (sources[own] & source or clusters[own] & cluster):
                break
            at += 1
        if at < len(order):
            residual, own = order.pop(at)
        else:
            residual, own = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[own] |= source
        clusters[own] |= cluster
        if residual > size:
            insort(order, (residual - size, own))
        placed.append(own)
    return placed


def _bits(values: pd.Series) -> list[int]:
    """A bit of its own for each value that occurs twice or more; others and nulls cannot conflict."""
    counts = values.value_counts()
    bit = {value: 1 << i for i, value in enumerate(counts.index[counts > 1])}
    return [bit.get(value, 0) for value in values]


def _pack_shard(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    frame = frame.sort_values(["size", "order", "doc_id", "start", "copy"], ascending=[False, True, True, True, True])
    pieces = zip(frame["size"].tolist(), _bits(frame["source"]), _bits(frame["cluster"]), strict=True)
    own = pd.Series(best_fit(list(pieces), capacity), index=frame.index, dtype="int64")
    return pd.DataFrame(
        {
            "bin": frame["shard"].to_numpy() * (1 << 32) + own,
            "slot": own.groupby(own).cumcount().astype("int32"),
            "doc_id": frame["doc_id"],
            "copy": frame["copy"],
            "start": frame["start"],
            "n_words": frame["size"],
        }
    )


def pack(docs: DataFrame, settings: Settings = Settings(), cluster: str | None = None) -> DataFrame:
    """``bin, slot, doc_id, copy, start, n_words``: pieces of documents, by word, and where they go.

    ``cluster`` names a column of duplicate clusters; without it, equal texts are a cluster.
    """
    capacity = settings.capacity
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    own = F.xxhash64(cluster) if cluster else F.xxhash64("text")
    named = F.when(F.col(cluster or "text").isNotNull(), own)
    items = docs.select("doc_id", "source", named.alias("cluster"), size.alias("words"))
    items = items.groupBy("doc_id", "source", "cluster", "words").agg(F.count(F.lit(1)).alias("copies"))
    items = items.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)"))).drop("copies")
    starts = F.when(
        F.col("words") > 0, F.sequence(F.lit(0).cast("long"), F.col("words") - 1, F.lit(capacity).cast("long"))
    )
    pieces = items.withColumn("start", F.explode_outer(starts)).select(
        "doc_id", "source", "cluster", "copy", F.coalesce("start", F.lit(0)).alias("start"),
        F.least(F.col("words") - F.coalesce("start", F.lit(0)), F.lit(capacity)).cast("long").alias("size"),
    )
    # From the number of rows and long texts: counting pieces exactly would compute them twice.
    shards = max(1, -(-docs.count() // settings.shard_pieces))
    order = F.xxhash64("doc_id", "cluster", "start", "copy", F.lit(settings.seed))
    dealt = pieces.withColumn("order", order).withColumn("shard", F.pmod("order", F.lit(shards)))
    schema = "bin long, slot int, doc_id long, copy long, start long, n_words long"
    packed = (
        dealt.where("size > 0").groupBy("shard").applyInPandas(lambda frame: _pack_shard(frame, capacity), schema)
    )
    nothing = pieces.where("size = 0").select(
        F.lit(None).cast("long").alias("bin"), F.lit(None).cast("int").alias("slot"),
        "doc_id", "copy", "start", F.col("size").alias("n_words"),
    )
    return packed.unionByName(nothing)
