"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3 ... and share as many words as there are. A target
above three times its source's words stops there, and the rest is shared again by weight.

Documents are dealt by hash into blocks. A source takes every block as often as its target holds its words, and
then blocks in a permuted order until the target is met; in the block where that happens, documents in hash order
while they fit, and a few more that fill the gap. That gives each source an exact quota of block draws. A tree over
the output shards halves the range of shards again and again; at each node the left half gets its size in draws,
split over the sources by a multivariate hypergeometric draw from the node's quotas. Each shard then owns a disjoint
run of every source's permuted draws, and its rows are shuffled among themselves.

Everything is DataFrame and SQL functions. Only hashes and sizes of documents are shuffled, already summed by
block; a hot source is spread over its blocks. The tree holds sources times shards, whatever the documents. The
plan of blocks is broadcast after its rows are counted, and joined by shuffle where it is large.

Defined results: a null or empty text has size 0 and is taken with its block, which adds no words; a null source
is a source; equal rows share one fate; an empty table gives no rows; other columns are carried along by ``draw``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import WORD, own_names, plain_names, stage

_NONE = "cast(array() as array<bigint>)"
_MIX = "__mix"  # everything that is added to documents sits in one struct of this name


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    block_docs: int = 64
    most_blocks: int = 4096
    shard_words: int = 1 << 17
    broadcast_rows: int = 50_000
    seed: int = 5


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _place(settings: Settings) -> Column:
    """Where a document stands in the permutation; equal documents stand together."""
    return F.xxhash64("doc_id", "text", F.lit(settings.seed))


def targets(sizes: DataFrame, settings: Settings) -> DataFrame:
    """One row per source of ``sizes(source, size)``: ``n_docs, words, rank, target``."""
    per_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("words"))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(float(w)) for w in settings.weights])
    ranked = per_source.withColumn("rank", rank).withColumn(
        "weight", F.element_at(weights, ((F.col("rank") - 1) % len(settings.weights) + 1).cast("int"))
    )
    # Sources in the order in which a rising level of words per weight would fill them up. The level at which all
    # words are shared is the highest of those that hold if all sources before are full.
    most = (F.col("words") * settings.most).cast("double")
    by_fill = Window.partitionBy().orderBy(most / F.col("weight"), "rank")
    before = F.coalesce(F.sum(most).over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    all_rows = Window.partitionBy()
    level = (F.sum("words").over(all_rows) - before) / after
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max("level").over(all_rows))
        .withColumn("target", F.least(most, F.col("level") * F.col("weight")))
        .select("source", "n_docs", "words", "rank", "target")
    )


def blocks(sizes: DataFrame, sources: DataFrame, settings: Settings) -> DataFrame:
    """One row per block: its order among the source's blocks, how often it is taken whole, and ``cut``.

    A document of the block is taken once more if its place is at most ``cut``, or among ``extra``.
    """
    n_blocks = F.least(F.ceil(F.col("n_docs") / settings.block_docs), F.lit(settings.most_blocks)).cast("long")
    full = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(1).cast("long")
    facts = sources.select(
        F.col("source").alias("of"), "words", "target", "rank", n_blocks.alias("n_blocks"), full.alias("full"),
        (F.col("target") - full * F.col("words")).alias("rest"),
    )
    in_block = (
        sizes.groupBy("source", "place")
        .agg(F.sum("size").alias("size"))
        .join(facts, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("block", F.pmod("place", "n_blocks"))
    )
    keys = ["source", "block", "words", "target", "rank", "n_blocks", "full", "rest"]
    order = Window.partitionBy("source").orderBy(F.xxhash64("source", "block", F.lit(settings.seed)), "block")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = (
        in_block.groupBy(*keys)
        .agg(F.sum("size").alias("size"))
        .select(*keys, "size", (F.row_number().over(order) - 1).cast("long").alias("position"), upto.alias("upto"))
        .withColumn("left", F.col("rest") - (F.col("upto") - F.col("size")))
    )
    # Blocks that are taken in part, one per source at most: their documents in hash order while they fit into what
    # is left; of those behind, the ones that fit into the gap in turn; and the one that best fills the last gap.
    # The documents of the last two steps are few: together they have fewer words than the first that did not fit.
    partial = whole.where((F.col("left") > 0) & (F.col("left") < F.col("size")))
    a_block = Window.partitionBy("source", "block")
    in_turn = a_block.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("through") <= F.col("left")
    second = ~first & (F.col("size") > 0) & (F.col("size") <= F.col("gap")) & (F.col("again") <= F.col("gap"))
    miss = F.abs(F.col("last_gap") - F.col("size"))
    last = ~first & ~second & (miss < F.col("last_gap"))
    cuts = (
        in_block.select("source", "block", "place", "size")
        .join(
            F.broadcast(partial.select(F.col("source").alias("of"), F.col("block").alias("at"), "left")),
            F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")),
        )
        .withColumn("through", F.sum("size").over(in_turn))
        .withColumn("gap", F.col("left") - F.coalesce(F.max(F.when(first, F.col("through"))).over(a_block), F.lit(0)))
        .withColumn("again", F.sum(F.when(~first & (F.col("size") <= F.col("gap")), F.col("size"))).over(in_turn))
        .withColumn("last_gap", F.col("gap") - F.coalesce(F.max(F.when(second, F.col("again"))).over(a_block), F.lit(0)))
        .groupBy(F.col("source").alias("of"), F.col("block").alias("at"))
        .agg(
            F.max(F.when(first, F.col("place"))).alias("cut"),
            F.collect_list(F.when(second, F.col("place"))).alias("second"),
            F.min_by("place", F.when(last, F.struct(miss, "place"))).alias("last"),
        )
        .withColumn("extra", F.array_compact(F.concat("second", F.array("last"))))
    )
    everything, nothing = F.lit((1 << 63) - 1), F.lit(None).cast("long")
    cut = F.when((F.col("size") > 0) & (F.col("left") >= F.col("size")), everything).when(
        F.col("left") > 0, F.col("cut")
    )
    return whole.join(
        cuts, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "left"
    ).select(*keys, "position", cut.otherwise(nothing).alias("cut"), F.coalesce("extra", F.expr(_NONE)).alias("extra"))


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric(good: str, total: str, drawn: str, uniform: str) -> str:
    """SQL of the number of good ones among ``drawn`` of ``total``, by inversion around the mode.

    Ten standard deviations to each side are summed; what lies beyond has a weight below 1e-20.
    """
    spread = "sqrt(n * (g / t) * (1 - g / t) * (t - n) / greatest(t - 1, 1))"
    mode = "floor((n + 1D) * (g + 1D) / (t + 2D))"
    first = f"cast(greatest(0, n - (t - g), {mode} - ceil(10 * {spread}) - 10) as bigint)"
    last = f"cast(least(n, g, {mode} + ceil(10 * {spread}) + 10) as bigint)"
    ratio = "(g - k) * cast(n - k as double) / ((k + 1) * cast(t - g - n + k + 1 as double))"
    weigh = (
        "aggregate(sequence(lo, hi), named_struct('p', 1D, 'sum', 0D), "
        f"(z, k) -> named_struct('p', z.p * {ratio}, 'sum', z.sum + z.p)).sum"
    )
    pick = (
        "aggregate(sequence(lo, hi), named_struct('p', 1D, 'sum', 0D, 'below', 0L), (z, k) -> named_struct("
        f"'p', z.p * {ratio}, 'sum', z.sum + z.p, 'below', z.below + if(z.sum + z.p <= goal, 1L, 0L))).below"
    )
    found = _let("goal", f"({uniform}) * {weigh}", f"least(hi, lo + {pick})")
    draw = f"if(t <= 0 or n <= 0 or g <= 0, 0L, {_let('lo', first, _let('hi', last, found))})"
    for name, value in (("n", drawn), ("t", total), ("g", good)):
        draw = _let(name, f"cast({value} as bigint)", draw)
    return draw


def split_quotas(quotas: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """``source, shard, start, n``: the run of its source's draws that a shard owns.

    ``quotas(source, rank, quota)`` has one row per source. The splitting tree starts as one row and doubles its
    rows with every level.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "source", "quota")))
    node = quotas.groupBy().agg(ordered.alias("sources")).select(
        "sources",
        F.transform("sources", lambda s: s["quota"]).alias("q"),
        F.lit(0).cast("long").alias("lo"),
        F.lit(shards).cast("long").alias("hi"),
    )
    total = "aggregate(q, 0L, (a, x) -> a + x)"
    node = node.withColumn("all", F.expr(total))

    def upto(shard: str) -> str:
        return f"floor(all * cast({shard} as double) / {shards})"

    uniform = f"shiftrightunsigned(xxhash64(lo, hi, i, {settings.seed}), 11) / {float(1 << 53)!r}D"
    draw = hypergeometric("element_at(q, i)", "acc.rest", "acc.n", uniform)
    drawn = _let(
        "d", draw,
        "named_struct('n', acc.n - d, 'rest', acc.rest - element_at(q, i), 'out', array_append(acc.out, d))",
    )
    zero = f"named_struct('n', cast({upto('mid')} - {upto('lo')} as bigint), 'rest', {total}, 'out', {_NONE})"
    left = f"if(hi - lo = 1, q, aggregate(sequence(1, size(q)), {zero}, (acc, i) -> {drawn}).out)"
    for level in range(max(shards - 1, 0).bit_length()):
        children = F.expr(
            "if(hi - lo = 1, array(named_struct('lo', lo, 'hi', hi, 'q', q)), array("
            "named_struct('lo', lo, 'hi', mid, 'q', left_q), "
            "named_struct('lo', mid, 'hi', hi, 'q', zip_with(q, left_q, (a, b) -> a - b))))"
        )
        node = (
            node.withColumn("mid", F.expr("cast(floor((lo + hi) / 2) as bigint)"))
            .withColumn("left_q", F.expr(left))
            .select("sources", "all", F.explode(children).alias("child"))
            .select("sources", "all", "child.*")
        )
        if level == 7:
            node = node.repartition("lo")
    dealt = node.select(F.col("lo").alias("shard"), F.posexplode("q").alias("i", "n"), "sources").select(
        "shard", "n", F.expr("element_at(sources, i + 1).source").alias("source")
    )
    earlier = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def plan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per source and block: its numbers, ``full``, ``cut``, and the shard of each of its draws."""
    sizes = stage(docs.select("source", _place(settings).alias("place"), size_of().alias("size")), "mix-sizes")
    sources = targets(sizes, settings)
    own = stage(blocks(sizes, sources, settings), "mix-blocks")
    draws = own.select(
        "source", "rank", "position", "n_blocks", "block", "words",
        (F.col("full") + (F.col("cut").isNotNull() | (F.size("extra") > 0)).cast("long")).alias("draws"),
    )
    words = own.select("source", "words").distinct().agg(F.sum("words")).first()[0] or 0
    shards = max(1, -(-words // settings.shard_words))
    quotas = draws.groupBy("source", "rank").agg(F.sum("draws").alias("quota"))
    runs = split_quotas(quotas, int(shards), settings)
    # Draw i of a source is the i-th of its blocks in permuted order, counted pass by pass; blocks that the last
    # pass takes are the first of the order, but for empty ones, so positions are numbered anew among the takers.
    # Blocks without draws go first: sequence(1, 0) counts down and has two entries.
    drawn = draws.where("draws > 0")
    passes = drawn.select("source", "block", "position", F.posexplode(F.expr("sequence(1L, draws)")).alias("p", "_"))
    passes = passes.select("source", "block", F.col("p").cast("long").alias("turn"), "position")
    numbered = passes.withColumn(
        "draw", F.row_number().over(Window.partitionBy("source").orderBy("turn", "position")).cast("long") - 1
    )
    owned = runs.where(F.col("n") > 0).select(
        F.col("source").alias("of"), "shard", F.explode(F.expr("sequence(start, start + n - 1)")).alias("at")
    )
    shards_of = (
        numbered.join(owned, F.col("source").eqNullSafe(F.col("of")) & (F.col("draw") == F.col("at")))
        .groupBy(F.col("source").alias("of"), F.col("block").alias("at"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("owners"))
    )
    joined = own.join(
        shards_of, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "left"
    )
    shard_list = F.coalesce(F.transform("owners", lambda o: o["shard"]), F.expr(_NONE))
    return stage(
        joined.select("source", "block", "n_blocks", "words", "target", "full", "cut", "extra", shard_list.alias("shards")),
        "mix-plan",
    )


def assign(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All rows of ``docs`` and a struct of ``size, source_size, target, place, shards``, one shard per time taken."""
    planned = plan(docs, settings).select(F.struct("*").alias("__plan"))
    if planned.count() <= settings.broadcast_rows:
        planned = F.broadcast(planned)
    counts = stage(planned.select("__plan.source", "__plan.n_blocks").distinct(), "mix-sources")
    if counts.count() <= settings.broadcast_rows:
        counts = F.broadcast(counts)
    counts = counts.select(F.struct("*").alias("__source"))
    placed = docs.withColumn("__place", _place(settings)).join(
        counts, F.col("source").eqNullSafe(F.col("__source.source"))
    )
    block = F.pmod("__place", "__source.n_blocks")
    joined = placed.join(
        planned, F.col("source").eqNullSafe(F.col("__plan.source")) & (block == F.col("__plan.block"))
    )
    once_more = F.coalesce(F.col("__place") <= F.col("__plan.cut"), F.lit(False)) | F.array_contains(
        "__plan.extra", F.col("__place")
    )
    copies = (F.col("__plan.full") + once_more.cast("long")).cast("int")
    mixed = F.struct(
        size_of().alias("size"),
        F.col("__plan.words").alias("source_size"),
        F.col("__plan.target").alias("target"),
        F.col("__place").alias("place"),
        F.slice("__plan.shards", F.lit(1), copies).alias("shards"),
    )
    return joined.select(*docs.columns, mixed.alias(_MIX))


def summary(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, size, source_size, target, taken, shards`` of every document."""
    found = assign(docs.select("doc_id", "text", "source"), settings)
    taken = F.col(f"{_MIX}.size") * F.size(f"{_MIX}.shards")
    return found.select(
        "doc_id",
        *[F.col(f"{_MIX}.{c}").alias(c) for c in ("size", "source_size", "target")],
        taken.cast("long").alias("taken"),
        F.col(f"{_MIX}.shards").alias("shards"),
    )


def draw(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The mixture: each row as often as it is taken, shard by shard, in random order within a shard."""
    docs, names = plain_names(docs, ["doc_id", "text", "source"])
    found = assign(docs, settings).select(
        *docs.columns, F.col(f"{_MIX}.place").alias("__at"), F.posexplode(f"{_MIX}.shards").alias("__turn", "__shard")
    )
    order = F.xxhash64("__at", "__turn", F.lit(settings.seed + 1))
    return own_names(found.repartition("__shard").sortWithinPartitions("__shard", order), names)
