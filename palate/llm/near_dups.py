"""Near-duplicate documents by bottom-k sketches, inverted lists and exact verification.

A document is the set of its distinct word shingles, as 64-bit hashes. One hash function orders all shingles,
and the ``k`` smallest of a set are its sketch. Documents with equal sets are one class from then on.

* **Inverted lists.** A list holds the classes that retain one value. Of two sets that are similar enough, at least
  ``least_shared`` of the ``k`` smallest values of the union are in both, but for a chance below 1e-9; so each class
  stays only in its rarest lists, all but ``least_shared - 1``, and similar sets still meet in one. That empties the
  lists of values that half the corpus retains. Sets no larger than their sketch need no such chance.
* **Stars.** Every list tests its members against one of them, which is linear in the list. Links found so far join
  classes to components, whose members need no test among each other; further rounds take their pivots from the
  component that is most frequent in the list, as long as they still link.
* **The rest, exactly.** Lists that still hold several components name members outside the most frequent one. Short
  lists are compared as a whole. Members of long ones are put into blocks, by longest list and size, and blocks that
  share a list are compared: one row per pair of blocks, so rows do not multiply with members that are alike but not
  linked.
* **Tests.** Sizes, then the estimate from the sketch of the union, then the Jaccard similarity of the full sets,
  which are computed anew from the texts concerned. Links inside a component are not repeated.

Hot lists and groups are pre-aggregated or blocked; where rows meet an aggregate of themselves it is staged first, so
that adaptive execution may split a hot value. Nothing is collected but counts.

Defined results: a text that is null or has no word has no shingles and its own component; rows with equal
``doc_id`` are one document; a row without ``doc_id`` has no component and is kept; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import map_batches, stage
from palate.llm.components import connected_components
from palate.sources.scratch import staged


#: Rounds of stars go on while so many of their tests link something.
LEAST_LINKED = 0.1


@dataclass(frozen=True)
class Settings:
    """Sets are linked from ``percent`` similarity on; shingles have ``words`` words."""

    words: int = 5
    percent: int = 80
    k: int = 48
    least_shared: int = 20
    rounds: int = 12
    block: int = 256
    block_shingles: int = 1 << 17
    queries: int = 1024
    broadcast_rows: int = 500_000

    @property
    def always_whole(self) -> int:
        """Below this size a set and all that may be linked with it are their own sketches."""
        return self.k * self.percent // 100

    def need(self, size: int) -> int:
        return -(-size * self.percent // 100) if size < self.always_whole else self.least_shared


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base)
    powers[:1] = 1
    return np.cumprod(powers)


def shingle_sets(texts: Sequence[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; all words as one shingle if there are fewer."""
    encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    data = np.frombuffer(b" ".join([b"", *encoded, b""]), np.uint8)
    is_space = (data == 32) | ((data >= 9) & (data <= 13))
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    edges = np.diff(is_space.view(np.int8))
    starts, ends = np.flatnonzero(edges == -1) + 1, np.flatnonzero(edges == 1) + 1
    # Hash of a word: sum of byte * factor ** place in it, from running sums over all texts at once.
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_FACTOR, len(data))))
    hashed = _mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(e) + 1 for e in encoded])
    upto = np.append(0, np.searchsorted(starts, text_ends, "right"))
    sets = []
    for first, last in zip(upto[:-1], upto[1:], strict=True):
        own = hashed[first:last]
        if len(own) == 0:
            sets.append(own)
            continue
        n = max(len(own) - words + 1, 1)
        rolled = own[:n].copy()
        for i in range(1, min(words, len(own))):
            rolled = _mix(rolled * _FACTOR + own[i : i + n])
        if len(own) < words:
            rolled = _mix(rolled + np.uint64(len(own)))
        sets.append(np.unique(rolled))
    return sets


def _digest(values: np.ndarray) -> tuple[int, int]:
    return int(_mix(values).sum().view(np.int64)), int(_mix(values + _FACTOR).sum().view(np.int64))


_SIGNATURES = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
        ("sketch", pa.list_(pa.int64())),
    ]
)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            sets = shingle_sets(part["text"], settings.words)
            digests = [_digest(s) for s in sets]
            yield {
                "doc_id": part["doc_id"],
                "n": [len(s) for s in sets],
                "h1": [d[0] for d in digests],
                "h2": [d[1] for d in digests],
                "sketch": [_ordered(s[: settings.k]) for s in sets],
            }

    return map_batches(docs, ["doc_id", "text"], run, _SIGNATURES, rows=256)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as signed ones of the same order."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def inverted_lists(classes: DataFrame, settings: Settings) -> DataFrame:
    """``value, id, n``: each class in its rarest lists, as many as are needed to meet all similar ones."""
    size = F.size("sketch")
    need = F.when(F.col("n") < settings.always_whole, F.ceil(F.col("n") * settings.percent / 100)).otherwise(
        settings.least_shared
    )
    entries = classes.select("id", "n", (size - need + 1).alias("keep"), size.alias("k"), F.explode("sketch").alias("value"))
    shared = stage(entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-values")
    own = Window.partitionBy("id", "n")
    return (
        entries.join(shared, "value")
        .withColumn("rank", F.row_number().over(own.orderBy("df", "value")))
        .withColumn("alone", F.col("k") - F.count(F.lit(1)).over(own))
        .where(F.col("alone") + F.col("rank") <= F.col("keep"))
        .select("value", "id", "n")
    )


def _similar_size(a: str, b: str, settings: Settings) -> Column:
    least, most = F.least(a, b), F.greatest(a, b)
    return least * 100 >= most * settings.percent


def _close_sketches(a: str, b: str, settings: Settings) -> Column:
    """The share of common values in the sketch of the union is not too small for similar sets."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, settings.k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return common * settings.k >= F.size(union) * settings.least_shared


_JOB = "block long, id long, others array<long>"


def _star_tests(lists: DataFrame, classes: DataFrame, settings: Settings, turn: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of one member per list with those of other components, and ``value, id`` of these pivots.

    ``lists`` has ``value, id, n, component``.
    """
    order = F.xxhash64("id", F.lit(turn))
    per_component = lists.groupBy("value", "component").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct(order.alias("order"), "id", "n")).alias("first")
    )
    pivots = (
        per_component.groupBy("value")
        .agg(
            F.max(F.struct("members", F.col("first.order").alias("order"), "first", "component")).alias("top"),
            F.count(F.lit(1)).alias("components"),
        )
        .where("components > 1")
        .select(
            "value",
            F.col("top.first.id").alias("pivot"),
            F.col("top.first.n").alias("pivot_n"),
            F.col("top.component").alias("pivot_component"),
        )
    )
    pivots = stage(pivots, "pivots")
    pairs = (
        lists.join(pivots, "value")
        .where("component <> pivot_component")
        .where(_similar_size("n", "pivot_n", settings))
        .select("id", "pivot")
        .distinct()
    )
    pairs = stage(pairs, "untested-pairs")
    sketches = _sketches_of(pairs.select(F.explode(F.array("id", "pivot")).alias("id")), classes, settings)
    # Both sides read the sketches under the same names, so that they are moved once for the two joins.
    own, other = sketches.alias("own"), sketches.alias("other")
    pairs = (
        pairs.select(F.col("id").alias("query"), "pivot")
        .join(own, F.col("query") == F.col("own.id"))
        .join(other, F.col("pivot") == F.col("other.id"))
        .where(_close_sketches("own.sketch", "other.sketch", settings))
        .select(F.col("query").alias("id"), "pivot")
    )
    return stage(pairs, "star-pairs"), pivots.select("value", F.col("pivot").alias("id"))


def _sketches_of(ids: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """``id, sketch`` of the classes in ``ids``; of all classes where these are too many to be told to every task."""
    sketches = classes.select("id", "sketch")
    wanted = stage(ids.select("id").distinct(), "wanted-sketches")
    if wanted.count() > settings.broadcast_rows:
        return sketches
    return sketches.join(F.broadcast(wanted), "id", "left_semi")


def _blocks(ids: DataFrame, settings: Settings) -> int:
    return max(1, math.ceil(ids.count() / settings.block))


def _block_of(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks))


def _jobs(pairs: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``id, pivot`` as rows of blocks: members without ``others``, and what each query is tested with."""
    blocks = _blocks(pairs.select("pivot").distinct(), settings)
    placed = pairs.select("id", "pivot", _block_of("pivot", blocks).alias("block"))
    members = placed.select("block", F.col("pivot").alias("id")).distinct()
    queries = placed.groupBy("block", "id").agg(F.collect_list("pivot").alias("others"))
    nothing = F.lit(None).cast("array<long>")
    return queries.unionByName(members.select("block", "id", nothing.alias("others")))


def _salted(jobs: DataFrame, settings: Settings) -> DataFrame:
    """Blocks with many queries are cut by query, and their members go to every part of the block."""
    parts = F.ceil(F.count("others") / settings.queries).cast("long")
    sizes = jobs.groupBy("block").agg(F.greatest(parts, F.lit(1).cast("long")).alias("parts"))
    own = F.array(F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    # One row per block of some hundred pivots.
    sized = jobs.join(F.broadcast(sizes), "block")
    return sized.withColumn("part", F.explode(F.when(F.col("others").isNull(), every).otherwise(own))).drop("parts")


class _Union:
    """Components that grow; ids point to one of theirs."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while (above := up.get(x, x)) != root:
            up[x] = root
            x = above
        return root

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def _links_in_block(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    is_member = frame["others"].isna()
    members = frame[is_member]
    sets = [np.frombuffer(s, np.uint64) for s in members["values"]]
    place: dict[int, list[int]] = {}
    for i, own in enumerate(members["id"]):
        place.setdefault(own, []).append(i)
    components = _Union()
    for own, component in zip(frame["id"], frame["component"], strict=True):
        if component != own:
            components.up.setdefault(own, component)
    links: list[tuple[int, int]] = []
    for query in frame[~is_member].itertuples():
        own = np.frombuffer(query.values, np.uint64)
        waiting = [o for o in query.others if o in place]
        for at in range(0, len(waiting), 32):
            mine = components.find(query.id)
            group = [o for o in waiting[at : at + 32] if components.find(o) != mine]
            chosen = [(o, sets[i]) for o in group for i in place[o]]
            if not chosen:
                continue
            sizes = np.array([len(s) for _, s in chosen])
            values = np.concatenate([s for _, s in chosen])
            hits = own[np.searchsorted(own, values).clip(max=len(own) - 1)] == values
            common = np.add.reduceat(hits, np.append(0, np.cumsum(sizes)[:-1]), dtype=np.int64)
            for (other, _), similar in zip(chosen, common * 100 >= (sizes + len(own) - common) * percent, strict=True):
                if similar and components.find(other) != components.find(query.id):
                    components.join(query.id, other)
                    links.append((query.id, other))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _sets(ids: DataFrame, docs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """``id, values``: the full sets of ``ids``, computed anew from their texts."""
    wanted = stage(
        classes.select("id", "h1").join(ids, "id").select(F.col("id").alias("__id"), F.col("h1").alias("__h1")), "wanted"
    )
    if wanted.count() <= settings.broadcast_rows:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "__h1")
    schema = pa.schema([("id", pa.int64()), ("values", pa.binary())])

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            found = [
                (doc_id, values.tobytes())
                for doc_id, h1, values in zip(
                    part["doc_id"], part["__h1"], shingle_sets(part["text"], settings.words), strict=True
                )
                if _digest(values)[0] == h1
            ]
            yield {"id": [f[0] for f in found], "values": [f[1] for f in found]}

    return map_batches(texts, ["doc_id", "text", "__h1"], run, schema, rows=256)


def _verify(jobs: DataFrame, docs: DataFrame, classes: DataFrame, components: DataFrame | None, settings: Settings):
    """``a, b`` that are similar, as far as they join components, for jobs of ``block, id, others``."""
    jobs = stage(jobs, "jobs")
    sets = _sets(jobs.select("id").distinct(), docs, classes, settings)
    rows = _with_component(_salted(jobs, settings), components).join(sets, "id")
    percent = settings.percent
    found = rows.groupBy("block", "part").applyInPandas(lambda f: _links_in_block(f, percent), "a long, b long")
    return stage(found, "found-links")


def _with_component(rows: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return rows.withColumn("component", F.col("id"))
    return rows.join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _close(xs: list[dict], ys: list[dict] | None, settings: Settings) -> tuple[list[int], list[int]]:
    """Members of ``xs`` outside their lists' main components and those of ``ys`` (None: of ``xs``) that come close.

    Close in size and sketch, and of another component; ids in pairs.
    """
    k, members = settings.k, xs if ys is None else ys
    sketches = np.full((len(members), max((len(m["sketch"]) for m in members), default=1)), np.iinfo(np.int64).max)
    for i, member in enumerate(members):
        sketches[i, : len(member["sketch"])] = member["sketch"]
    lengths = np.array([len(m["sketch"]) for m in members])
    valid = np.arange(sketches.shape[1]) < lengths[:, None]
    ids, sizes, components = (np.array([m[c] for m in members], np.int64) for c in ("id", "n", "component"))
    left, right = [], []
    for place, query in enumerate(xs):
        if not query["outside"]:
            continue
        own = np.asarray(query["sketch"])
        at = np.searchsorted(own, sketches)
        hit = (own[at.clip(max=len(own) - 1)] == sketches) & valid
        before = np.cumsum(hit, axis=1) - hit
        common = (hit & (at + np.arange(sketches.shape[1]) - before < k)).sum(axis=1)
        union = np.minimum(k, lengths + len(own) - hit.sum(axis=1))
        close = (components != query["component"]) & (common * k >= union * settings.least_shared)
        close &= np.minimum(sizes, query["n"]) * 100 >= np.maximum(sizes, query["n"]) * settings.percent
        if ys is None:
            close[: place + 1] = False
        near = ids[close].tolist()
        left += [query["id"]] * len(near)
        right += near
    return left, right


_CLOSE = pa.schema(
    [("x", pa.int64()), ("y", pa.int64()), ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64()))]
)
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _close_in_lists(entries: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """``id, pivot`` of what comes close in lists of a block's size at most; each list is compared as a whole."""
    sketched = entries.join(_sketches_of(entries, classes, settings), "id").groupBy("value")
    held = sketched.agg(F.collect_list(F.struct("id", "n", "component", "outside", "sketch")).alias("held"))
    schema = pa.schema([("id", pa.int64()), ("pivot", pa.int64())])

    def compare(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            for xs in part["held"]:
                # Members outside first: a pair is compared from the first of its two.
                left, right = _close(sorted(xs, key=lambda m: (not m["outside"], m["id"])), None, settings)
                yield {"id": left, "pivot": right}

    return stage(map_batches(held, ["held"], compare, schema, rows=64).distinct(), "close-in-lists")


def _mixed_blocks(entries: DataFrame, settings: Settings) -> DataFrame:
    """``id, n, component, outside, kind, block`` of the members of long lists.

    Blocks hold members of one size class whose longest list is the same, a bounded number of them and of their
    shingles; ``kind`` tells the size class and whether they are outside of main components.
    """
    size_class = F.floor(F.log("n") / math.log(100 / settings.percent)).cast("long")
    members = entries.groupBy("id", "n", "component").agg(
        F.max("outside").alias("outside"), F.max(F.struct("size", "value")).alias("longest")
    )
    kind = (size_class * 2 + F.col("outside").cast("long")).alias("kind")
    members = stage(members.select("*", F.col("longest.value").alias("home"), kind).drop("longest"), "mixed-members")
    room = F.greatest(
        F.ceil(F.count(F.lit(1)) / settings.block), F.ceil(F.sum("n") / settings.block_shingles)
    )
    parts = stage(members.groupBy("home", "kind").agg(room.alias("parts")), "mixed-parts")
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    block = F.xxhash64("home", "kind", part).alias("block")
    return members.join(parts, ["home", "kind"]).select("id", "n", "component", "outside", "kind", block)


def _block_pairs(entries: DataFrame, members: DataFrame) -> DataFrame:
    """``x, y``: a block of outside members and one that shares a list with it, of similar size; each pair once."""
    held = members.select("id", F.struct("kind", "block").alias("at"))
    is_outside = F.col("at.kind") % 2 == 1
    lists = entries.select("value", "id").join(held, "id").groupBy("value").agg(
        F.array_sort(F.collect_set(F.when(is_outside, F.col("at")))).alias("outside"),
        F.array_sort(F.collect_set(F.when(~is_outside, F.col("at")))).alias("others"),
    )
    # Lists of one group mostly lead to the same blocks.
    lists = lists.select("outside", "others").distinct()
    pairs = lists.select(F.explode("outside").alias("x"), F.concat("outside", "others").alias("all"))
    pairs = pairs.select("x", F.explode("all").alias("y"))
    classes = [F.floor(F.col(f"{c}.kind") / 2) for c in ("x", "y")]
    both_outside = F.col("y.kind") % 2 == 1
    pairs = pairs.where(F.abs(classes[0] - classes[1]) <= 1).where(~both_outside | (F.col("x") <= F.col("y")))
    return stage(pairs.select(F.col("x.block").alias("x"), F.col("y.block").alias("y")).distinct(), "pairs-of-blocks")


def _meet(pairs: DataFrame, blocks: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of pairs of blocks with what either holds, as ``held_x`` and ``held_y``; a block alone has no second."""
    x, y = (blocks.select(F.col("block").alias(c), F.col("held").alias(f"held_{c}")) for c in ("x", "y"))
    other = F.when(F.col("x") != F.col("y"), F.col("y"))
    joined = pairs.join(x, "x").withColumn("__y", other).join(y.withColumnRenamed("y", "__y"), "__y", "left")
    return joined.select(*columns, "held_x", "held_y")


def _left_over(
    lists: DataFrame, docs: DataFrame, classes: DataFrame, components: DataFrame, settings: Settings
) -> list[DataFrame]:
    """Links between members of different components that still share one of ``lists(value, id, n, component)``."""
    per_component = lists.groupBy("value", "component").agg(F.count(F.lit(1)).alias("members"))
    mixed = per_component.groupBy("value").agg(
        F.max(F.struct("members", "component")).alias("top"),
        F.sum("members").alias("size"),
        F.count(F.lit(1)).alias("components"),
    )
    mixed = mixed.where("components > 1").select("value", "size", F.col("top.component").alias("main"))
    entries = lists.join(stage(mixed, "mixed-values"), "value").withColumn("outside", F.col("component") != F.col("main"))
    entries = stage(entries.select("value", "size", "id", "n", "component", "outside"), "mixed-lists")
    short, long = entries.where(F.col("size") <= settings.block), entries.where(F.col("size") > settings.block)
    found = []
    pairs = _close_in_lists(short, classes, settings)
    if not pairs.isEmpty():
        found.append(_verify(_jobs(pairs, settings), docs, classes, components, settings))
    if not long.isEmpty():
        found.append(_links_between_blocks(long, docs, classes, settings))
    return found


def _links_between_blocks(entries: DataFrame, docs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    members = _mixed_blocks(entries, settings)
    pairs = _block_pairs(entries, members)
    sketched = members.join(_sketches_of(members, classes, settings), "id").groupBy("block")
    held = F.collect_list(F.struct("id", "n", "component", "outside", "sketch")).alias("held")
    blocks = stage(sketched.agg(held), "sketch-blocks")

    def compare(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            for x, y, xs, ys in zip(*(part[c] for c in ("x", "y", "held_x", "held_y")), strict=True):
                left, right = _close(xs, ys, settings)
                if left:
                    yield {"x": [x], "y": [y], "left": [left], "right": [right]}

    columns = ["x", "y"]
    close = map_batches(_meet(pairs, blocks, columns), [*columns, "held_x", "held_y"], compare, _CLOSE, rows=8)
    close = stage(close, "close-blocks")
    concerned = close.select(F.explode(F.array("x", "y")).alias("block")).distinct()
    wanted = stage(members.join(concerned, "block").select("id", "component", "block"), "close-members")
    sets = _sets(wanted.select("id"), docs, classes, settings).groupBy("id").agg(F.first("values").alias("values"))
    packed = wanted.join(sets, "id").groupBy("block")
    blocks = stage(packed.agg(F.collect_list(F.struct("id", "component", "values")).alias("held")), "set-blocks")
    percent = settings.percent

    def confirm(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            for left, right, xs, ys in zip(*(part[c] for c in ("left", "right", "held_x", "held_y")), strict=True):
                own = {m["id"]: m for m in [*xs, *(ys or [])]}
                others: dict[int, list[int]] = {}
                for a, b in zip(left, right, strict=True):
                    others.setdefault(a, []).append(b)
                rows = [(own[b]["id"], own[b]["component"], None, own[b]["values"]) for b in sorted(set(right))]
                rows += [(a, own[a]["component"], near, own[a]["values"]) for a, near in others.items()]
                frame = pd.DataFrame(rows, columns=["id", "component", "others", "values"])
                links = _links_in_block(frame, percent)
                if len(links):
                    yield {"a": links["a"].tolist(), "b": links["b"].tolist()}

    columns = ["x", "y", "left", "right"]
    links = map_batches(_meet(close, blocks, columns), [*columns, "held_x", "held_y"], confirm, _LINKS, rows=4)
    return stage(links, "found-links")


def classes_of(found: DataFrame) -> DataFrame:
    """``n, h1, h2, id, sketch``: one row per distinct set, named by its smallest document."""
    return (
        found.where("n > 0 and doc_id is not null")
        .groupBy("n", "h1", "h2")
        .agg(F.min(F.struct("doc_id", "sketch")).alias("first"))
        .select("n", "h1", "h2", F.col("first.doc_id").alias("id"), F.col("first.sketch").alias("sketch"))
    )


def keep_first(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its group.

    Those to drop are looked up, as they are fewer, so that texts are moved only where they are too many to be told to
    every task. Rows without id are first of a group each.
    """
    groups = components(docs, settings)
    dropped = groups.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("not kept").select("doc_id")
    dropped = stage(dropped, "dropped")
    if dropped.count() <= settings.broadcast_rows:
        dropped = F.broadcast(dropped)
    # A join by a condition, as null ids match nothing and the columns keep their order.
    return docs.join(dropped, docs["doc_id"] == dropped["doc_id"], "left_anti")


def components(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    docs = docs.select("doc_id", "text")
    with staged(signatures(docs, settings), "signatures") as signed:
        # Sketches are kept once per class, not once per document.
        classes = stage(classes_of(signed), "set-classes")
        found = stage(signed.drop("sketch"), "digests")
    lists = stage(inverted_lists(classes, settings), "lists")
    links, joined = None, None
    for turn in range(settings.rounds):
        pairs, pivots = _star_tests(_with_component(lists, joined), classes, settings, turn)
        new = _verify(_jobs(pairs, settings), docs, classes, joined, settings)
        links = new if links is None else links.unionByName(new)
        joined = stage(connected_components(links), "components")
        # A pivot has met all of its list.
        lists = lists.join(pivots, ["value", "id"], "left_anti")
        lists = stage(lists, "lists-left")
        if turn and new.count() < LEAST_LINKED * pairs.count():
            break
    more = _left_over(_with_component(lists, joined), docs, classes, joined, settings)
    if more:
        joined = stage(connected_components(reduce(DataFrame.unionByName, more, links)), "components")
    named = classes.select("n", "h1", "h2", "id").join(joined, "id", "left")
    named = named.select("n", "h1", "h2", F.coalesce("component", "id").alias("component"))
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (
        found.join(named, ["n", "h1", "h2"], "left")
        .withColumn("component", F.when(F.col("doc_id").isNotNull(), component))
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.col("component").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    )


#: The same for two-word shingles, by comparing all documents that share one.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS s FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
numbered AS MATERIALIZED (SELECT doc_id, hash(s) AS s FROM shingles),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM numbered a JOIN numbered b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY 1) c ON c.a = d.doc_id"""
