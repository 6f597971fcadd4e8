"""Boosted trees for several targets at once: leaf-wise growth on histograms of binned features.

Features are cut at quantiles once. A round grows one tree per target, all in the same passes over the rows: tasks sum
residuals and rows by (target, leaf, feature, bin), these histograms are added up in the cluster, and only the best
split of each leaf reaches the driver. Growth is best-first, as leaf limits ask for: the leaf whose split gains most
goes next. A pass evaluates every leaf that may still be split in the order known so far, so a tree takes about as
many passes as it is deep, not one per leaf; leaves looked at in vain are dropped again.

Residuals are whole numbers in units of ``2 ** -30``, so sums do not depend on the order of rows, and a model does not
depend on how its rows are dealt or on tasks that ran twice. The rows with their residuals are rewritten every few
rounds; until then a pass takes the trees since then off the residuals as it reads them. Nothing is cached.

Many trees on rows that fit a task are grown apart instead: a task per target reads all binned rows once and grows that
target's trees, in the same order and to the same numbers, so a tree costs no pass.

The driver holds the model, the cuts and one best split per leaf, whose sizes follow from the parameters. A task holds
the histograms of the leaves of one pass.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.settings import BoostingParams
from palate.sources.scratch import staged

# Tasks get these functions with their code, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 1 << 30
#: Features whose histograms meet in one group.
_CHUNK = 32
_BATCH = 2048
#: Rows times features, a byte each, that one task holds to grow the trees of a target by itself.
_CELLS_OF_A_TASK = 100_000_000
#: From how many trees on that is worth reading all rows once per target.
_MANY_TREES = 10
#: Splits must reduce the squared error by more than rounding can.
_LEAST = 1 + 1e-12


@dataclass
class Tree:
    """Nodes by number, 0 being the root; a node without feature (-1) is a leaf worth ``value`` units."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, upto: int) -> tuple[int, int]:
        """Rows whose bin of ``feature`` is at most ``upto`` go to the first of two new nodes, others to the second."""
        left = len(self.feature)
        self.feature[node], self.bin[node], self.left[node] = feature, upto, left
        for own, empty in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.value, 0)):
            own.extend((empty, empty))
        return left, left + 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, upto, left = (np.array(own, np.int64) for own in (self.feature, self.bin, self.left))
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        while len(rows):
            at = node[rows]
            node[rows] = left[at] + (bins[rows, feature[at]] > upto[at])
            rows = rows[feature[node[rows]] >= 0]
        return node

    def add(self, bins: np.ndarray, totals: np.ndarray) -> None:
        totals += np.array(self.value, np.int64)[self.leaves(bins)]


@dataclass(frozen=True)
class Ensemble:
    """``trees[round][target]`` over bins: a feature's bin is the number of its ``cuts`` that lie below the value."""

    cuts: list[list[float]]
    base: list[int]
    trees: list[list[Tree]]

    def scores(self, features: np.ndarray) -> np.ndarray:
        bins = to_bins(features, self.cuts)
        totals = np.tile(np.array(self.base, np.int64), (len(bins), 1))
        for trees in self.trees:
            for target, tree in enumerate(trees):
                tree.add(bins, totals[:, target])
        return totals / UNIT


def to_bins(features: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    columns = [np.searchsorted(own, column, side="left") for own, column in zip(cuts, features.T, strict=True)]
    return np.stack(columns, axis=1).astype(np.uint8) if columns else np.zeros(features.shape, np.uint8)


def feature_cuts(rows: DataFrame, columns: Sequence[str], bins: int, per_pass: int = 64) -> list[list[float]]:
    """At most ``bins - 1`` values per column at evenly spaced ranks; the greatest value is no cut.

    Ranks are exact up to some thousand rows and within a ten-thousandth of them beyond.
    """
    wanted = [i / bins for i in range(1, bins)]
    found: list[list[float]] = []
    for first in range(0, len(columns), per_pass):
        # One aggregate over melted columns; few enough that their sketches stay in a hash table.
        own = F.array(*[F.col(f"`{c}`") for c in columns[first : first + per_pass]])
        melted = rows.select(F.posexplode(own).alias("position", "value")).groupBy("position")
        result = melted.agg(F.percentile_approx("value", wanted, 10_000).alias("cuts"), F.max("value").alias("greatest"))
        by_place = {row["position"]: row for row in result.collect()}
        for place in range(len(columns[first : first + per_pass])):
            row = by_place.get(place)
            found.append(sorted({v for v in row["cuts"] or [] if v < row["greatest"]}) if row else [])
    return found


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            yield batch.slice(at, _BATCH)


_STATE = "bins binary, residuals binary"


def _binned(rows: DataFrame, features: Sequence[str], targets: Sequence[str], cuts, base: list[int]) -> DataFrame:
    n_features, n_targets = len(features), len(targets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            bins = to_bins(_matrix(batch.column(0), n_features), cuts)
            residuals = units(_matrix(batch.column(1), n_targets)) - np.array(base, np.int64)
            yield _packed(bins, residuals)

    columns = [F.array(*[F.col(f"`{c}`").cast("double") for c in own]) for own in (features, targets)]
    return rows.select(columns[0].alias("features"), columns[1].alias("targets")).mapInArrow(run, _STATE)


def units(values: np.ndarray) -> np.ndarray:
    return np.floor(values * UNIT + 0.5).astype(np.int64)


def _packed(bins: np.ndarray, residuals: np.ndarray) -> pa.RecordBatch:
    columns = [[row.tobytes() for row in own] for own in (bins, residuals)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["bins", "residuals"])


def _advanced(state: DataFrame, trees: list[list[Tree]], n_features: int, n_targets: int) -> DataFrame:
    """The rows with ``trees`` taken off their residuals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            yield _packed(*_left(batch, trees, n_features, n_targets))

    return state.mapInArrow(run, _STATE)


def _left(batch: pa.RecordBatch, trees: list[list[Tree]], n_features: int, n_targets: int):
    bins = _unpacked(batch.column(0), "u1", n_features)
    gone = np.zeros((len(bins), n_targets), np.int64)
    for own in trees:
        for target, tree in enumerate(own):
            tree.add(bins, gone[:, target])
    return bins, _unpacked(batch.column(1), "<i8", n_targets) - gone


@dataclass
class Split:
    """The best split of a node with ``rows`` rows whose residuals sum to ``total``."""

    gain: float
    feature: int
    bin: int
    left_total: int
    left_rows: int
    total: int
    rows: int


@dataclass
class _Growth:
    """A tree that grows, and what is known of its nodes; some may turn out not to belong to it."""

    budget: int
    tree: Tree = field(default_factory=Tree)
    known: dict[int, Split] = field(default_factory=dict)
    children: dict[int, tuple[int, int]] = field(default_factory=dict)

    def order(self) -> tuple[list[int], list[int]]:
        """Nodes in the order in which they are split as far as known, and those whose children must be looked at."""
        waiting = [(-self.known[0].gain, 0)] if self._splits(0) else []
        chosen, unknown = [], []
        while waiting and len(chosen) < self.budget:
            _, node = heapq.heappop(waiting)
            chosen.append(node)
            if len(chosen) == self.budget:
                break
            pair = self.children.get(node)
            if pair is None:
                unknown.append(node)
                continue
            for child in pair:
                if self._splits(child):
                    heapq.heappush(waiting, (-self.known[child].gain, child))
        return chosen, unknown

    def _splits(self, node: int) -> bool:
        return node in self.known and self.known[node].gain > 0

    def open(self, nodes: list[int]) -> list[int]:
        """Split nodes for a look at their children; returns these."""
        opened = []
        for node in nodes:
            best = self.known[node]
            self.children[node] = self.tree.split(node, best.feature, best.bin)
            opened += self.children[node]
        return opened

    def finished(self, rate: float) -> Tree:
        """The tree of the chosen splits alone, with the values of its leaves."""
        done, place = Tree(), {0: 0}
        sums = {0: (self.known[0].total, self.known[0].rows)}
        for node in self.order()[0]:
            best = self.known[node]
            pair = self.children.get(node, (-2 * node - 1, -2 * node - 2))  # the last split's children were not needed
            new = done.split(place[node], best.feature, best.bin)
            place.update(zip(pair, new, strict=True))
            sums[new[0]] = (best.left_total, best.left_rows)
            sums[new[1]] = (best.total - best.left_total, best.rows - best.left_rows)
        for node, feature in enumerate(done.feature):
            total, rows = sums[node]
            if feature < 0 and rows:
                done.value[node] = int(np.floor(rate * total / rows + 0.5))
        return done


_HISTOGRAM = "target int, node int, chunk int, sums binary"
_SPLIT = "target int, node int, gain double, feature int, bin int, left_total long, left_rows long, total long, rows long"


def _histograms(state, recent, growing: list[_Growth], wanted: list[list[int]], n_features: int, bins: int) -> DataFrame:
    """Residuals and rows by (target, node, feature, bin), as packed sums of every task."""
    trees, n_targets = [g.tree for g in growing], len(growing)
    slots = []
    for tree, nodes in zip(trees, wanted, strict=True):
        own = np.full(len(tree.feature), -1, np.int64)
        own[nodes] = np.arange(len(nodes))
        slots.append(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = n_features * bins
        sums = [np.zeros((2, len(nodes) * width), np.int64) for nodes in wanted]
        offsets = np.arange(n_features) * bins
        seen = False
        for batch in _batches(batches):
            binned, residuals = _left(batch, recent, n_features, n_targets)
            seen = seen or bool(len(binned))
            place = binned + offsets
            for target, tree in enumerate(trees):
                if not wanted[target]:
                    continue
                slot = slots[target][tree.leaves(binned)]
                rows = np.flatnonzero(slot >= 0)
                cells = (place[rows] + slot[rows, None] * width).ravel()
                weights = np.repeat(residuals[rows, target].astype(float), n_features)
                # Whole numbers far below 2 ** 53, so these floats are exact.
                sums[target][0] += np.bincount(cells, weights, len(wanted[target]) * width).astype(np.int64)
                sums[target][1] += np.bincount(cells, minlength=len(wanted[target]) * width)
        if not seen:
            return
        for target, nodes in enumerate(wanted):
            own = sums[target].reshape(2, len(nodes), n_features, bins)
            for slot, node in enumerate(nodes):
                chunks = range(0, n_features, _CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([target] * len(chunks), pa.int32()),
                        pa.array([node] * len(chunks), pa.int32()),
                        pa.array([first // _CHUNK for first in chunks], pa.int32()),
                        pa.array([_sums_packed(own[:, slot, first : first + _CHUNK]) for first in chunks], pa.binary()),
                    ],
                    ["target", "node", "chunk", "sums"],
                )

    return state.mapInArrow(run, _HISTOGRAM)


def _sums_packed(sums: np.ndarray) -> bytes:
    """A task has less than 2 ** 31 rows, so four bytes hold its counts."""
    return sums[0].tobytes() + sums[1].astype(np.int32).tobytes()


def best_split(residuals: np.ndarray, rows: np.ndarray, least: int) -> tuple[float, int, int]:
    """Gain, feature and bin of the best split of histograms by feature and bin; the first of equally good ones."""
    total, count = int(residuals[0].sum()), int(rows[0].sum())
    left, left_rows = np.cumsum(residuals, axis=1)[:, :-1], np.cumsum(rows, axis=1)[:, :-1]
    right, right_rows = total - left, count - left_rows
    allowed = (left_rows >= max(least, 1)) & (right_rows >= max(least, 1))
    if not allowed.any():
        return 0.0, -1, 0
    whole = float(total) * float(total) / count
    with np.errstate(divide="ignore", invalid="ignore"):
        worth = left.astype(float) ** 2 / left_rows + right.astype(float) ** 2 / right_rows
    worth = np.where(allowed & (worth > whole * _LEAST), worth, -1.0)
    at = int(worth.argmax())
    if worth.flat[at] < 0:
        return 0.0, -1, 0
    return float(worth.flat[at]) - whole, *map(int, np.unravel_index(at, worth.shape))


def _best(histograms: DataFrame, n_features: int, bins: int, least: int) -> DataFrame:
    """The best split of every node and chunk, once the sums of all tasks are added up; rows come sorted by these."""

    def split(key: tuple[int, int, int], sums: np.ndarray) -> tuple:
        gain, feature, upto = best_split(*sums, least)
        left = sums[:, feature, : upto + 1].sum(axis=1) if feature >= 0 else (0, 0)
        feature = key[2] * _CHUNK + feature if feature >= 0 else -1
        return (key[0], key[1], gain, feature, upto, *left, *sums[:, 0].sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, int] | None = None
        sums = np.zeros(0)
        found = []
        for batch in batches:
            for *key, own in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if tuple(key) != held:
                    if held is not None:
                        found.append(split(held, sums))
                    held = tuple(key)
                    sums = np.zeros((2, min(_CHUNK, n_features - key[2] * _CHUNK), bins), np.int64)
                cells = sums[0].size
                sums[0] += np.frombuffer(own, np.int64, cells).reshape(sums[0].shape)
                sums[1] += np.frombuffer(own, np.int32, cells, 8 * cells).reshape(sums[1].shape)
        if held is not None:
            found.append(split(held, sums))
            names, kinds = zip(*(column.split() for column in _SPLIT.split(", ")), strict=True)
            types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
            columns = [pa.array(values, types[kind]) for values, kind in zip(zip(*found), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, list(names))

    keys = ["target", "node", "chunk"]
    return histograms.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _SPLIT)


def _grow(state, recent, n_features: int, n_targets: int, params: BoostingParams) -> list[Tree]:
    bins = params.bins
    growing = [_Growth(max(params.leaves - 1, 0)) for _ in range(n_targets)]
    wanted = [[0] for _ in growing]
    while any(wanted):
        sums = _histograms(state, recent, growing, wanted, n_features, bins)
        for row in sorted(_best(sums, n_features, bins, params.min_rows_per_leaf).collect(), key=lambda r: r["feature"]):
            known = growing[row["target"]].known
            found = Split(*row[2:])
            if row["node"] not in known or found.gain > known[row["node"]].gain:
                known[row["node"]] = found
        wanted = [own.open(own.order()[1]) for own in growing]
    return [own.finished(params.learning_rate) for own in growing]


_TREE = "target int, number int, feature array<long>, bin array<long>, left array<long>, value array<long>"


def _grown_apart(state: DataFrame, n: int, n_features: int, n_targets: int, params: BoostingParams) -> list[list[Tree]]:
    """All trees on the ``n`` rows of ``state``, those of each target grown in a task of its own."""

    def grow(target: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins, left_over, done = np.empty((n, n_features), np.uint8), np.empty(n, np.int64), 0
            for batch in _batches(batches):
                upto = done + batch.num_rows
                bins[done:upto] = _unpacked(batch.column(0), "u1", n_features)
                left_over[done:upto] = _unpacked(batch.column(1), "<i8", 1)[:, 0]
                done = upto
            if done != n:
                raise ValueError(f"{done} rows instead of {n}")
            for number, tree in enumerate(_grown_alone(bins, left_over, params)):
                columns = [[target], [number], [tree.feature], [tree.bin], [tree.left], [tree.value]]
                kinds = [pa.int32()] * 2 + [pa.list_(pa.int64())] * 4
                names = ["target", "number", "feature", "bin", "left", "value"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        own = F.substring("residuals", 8 * target + 1, 8)
        return state.select("bins", own.alias("residual")).coalesce(1).mapInArrow(run, _TREE)

    rounds: list[list[Tree]] = [[Tree()] * n_targets for _ in range(params.trees)]
    # A union of frames that have one partition each is one task again; one of RDDs is not.
    for row in state.sparkSession.sparkContext.union([grow(target).rdd for target in range(n_targets)]).collect():
        rounds[row["number"]][row["target"]] = Tree(*map(list, row[2:]))
    for number, grown in enumerate(rounds):
        if not any(tree.feature[0] >= 0 for tree in grown):
            return rounds[: number + 1]  # nothing left that a split improves
    return rounds


def _grown_alone(bins: np.ndarray, left_over: np.ndarray, params: BoostingParams) -> Iterator[Tree]:
    """The trees of one target; ``left_over`` are its residuals. Only the smaller of two new nodes is summed."""
    least = params.min_rows_per_leaf
    for _ in range(params.trees):
        growth = _Growth(max(params.leaves - 1, 0))
        rows_of = {0: np.arange(len(bins), dtype=np.int32)}
        sums_of = {0: _sums(bins, rows_of[0], left_over, params.bins)}
        growth.known[0] = _best_of(sums_of[0], least)
        while unknown := growth.order()[1]:
            growth.open(unknown)
            for node in unknown:
                rows, whole, best = rows_of.pop(node), sums_of.pop(node), growth.known[node]
                low = bins[rows, best.feature] <= best.bin
                parts = [*zip(growth.children[node], (rows[low], rows[~low]), strict=True)]
                parts.sort(key=lambda part: len(part[1]))
                if len(parts[1][1]) < 2 * max(least, 1):
                    continue
                small = _sums(bins, parts[0][1], left_over, params.bins)
                for (child, own), sums in zip(parts, (small, whole - small), strict=True):
                    if len(own) >= 2 * max(least, 1):
                        rows_of[child], sums_of[child], growth.known[child] = own, sums, _best_of(sums, least)
        tree = growth.finished(params.learning_rate)
        gone = np.zeros(len(bins), np.int64)
        tree.add(bins, gone)
        left_over = left_over - gone
        yield tree


def _sums(bins: np.ndarray, rows: np.ndarray, left_over: np.ndarray, n_bins: int) -> np.ndarray:
    """Residuals and rows by feature and bin."""
    width = bins.shape[1] * n_bins
    sums, offsets = np.zeros((2, width), np.int64), np.arange(bins.shape[1]) * n_bins
    for at in range(0, len(rows), _BATCH):
        own = rows[at : at + _BATCH]
        cells = (bins[own] + offsets).ravel()
        # Exact, as in a pass.
        weights = np.repeat(left_over[own].astype(float), bins.shape[1])
        sums[0] += np.bincount(cells, weights, width).astype(np.int64)
        sums[1] += np.bincount(cells, minlength=width)
    return sums.reshape(2, bins.shape[1], n_bins)


def _best_of(sums: np.ndarray, least: int) -> Split:
    """The best split of a node from the sums of all features, compared by chunks as in a pass."""
    found: Split | None = None
    for first in range(0, sums.shape[1], _CHUNK):
        own = sums[:, first : first + _CHUNK]
        gain, feature, upto = best_split(*own, least)
        if found is None or gain > found.gain:
            left = own[:, feature, : upto + 1].sum(axis=1) if feature >= 0 else (0, 0)
            place = first + feature if feature >= 0 else -1
            found = Split(gain, place, upto, *map(int, left), *map(int, own[:, 0].sum(axis=1)))
    assert found is not None
    return found


def _means(rows: DataFrame, targets: Sequence[str]) -> tuple[int, list[int]]:
    """How many rows there are, and the mean of every target in whole units, 0 without rows."""
    whole = [F.floor(F.col(f"`{t}`") * UNIT + 0.5).cast("decimal(38,0)") for t in targets]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.array(*map(F.sum, whole)).alias("sums")).first()
    n = sums["n"]
    return n, [int(total) // n for total in sums["sums"]] if n else [0] * len(targets)


def _tasks(n: int, parallel: int) -> int:
    """Tasks of a pass: at most 200,000 rows each, and as many as cores or a multiple, so that none waits for a last one."""
    if n <= parallel * 8192:
        return -(-n // 8192)
    return -(-n // (parallel * 200_000)) * parallel


def fit(
    rows: DataFrame, features: Sequence[str], targets: Sequence[str], params: BoostingParams, rewrite_every: int = 10
) -> Ensemble:
    """Trees for every column of ``targets``, fitted to its squared error on ``features``.

    A tree has at most ``params.leaves`` leaves of at least ``params.min_rows_per_leaf`` rows; training starts from
    the mean. Without rows every score is 0.
    """
    spark = rows.sparkSession
    if params.leaves < 2:
        # Nothing is split, so no feature is read and no row written.
        return Ensemble([[] for _ in features], _means(rows, targets)[1], [])
    with staged(rows.select(*[F.col(f"`{c}`") for c in [*features, *targets]]), "boosting-rows") as own:
        n, base = _means(own, targets)
        if not n:
            return Ensemble([[] for _ in features], base, [])
        cuts = feature_cuts(own, features, params.bins)
        trees: list[list[Tree]] = []
        recent: list[list[Tree]] = []
        # Binned before they are dealt: a feature is a byte then. The numbers of a row follow from the row alone.
        binned = _binned(own, features, targets, cuts, base).repartition(_tasks(n, spark.sparkContext.defaultParallelism))
        if params.trees >= _MANY_TREES and features and n * len(features) <= _CELLS_OF_A_TASK:
            with staged(binned, "boosting-state") as state:
                return Ensemble(cuts, base, _grown_apart(state, n, len(features), len(targets), params))
        kept = ExitStack()
        try:
            state = kept.enter_context(staged(binned, "boosting-state"))
            while len(trees) < params.trees:
                grown = _grow(state, recent, len(features), len(targets), params)
                trees.append(grown)
                recent = [*recent, grown]
                if not any(tree.feature[0] >= 0 for tree in grown):
                    break  # nothing left that a split improves
                if len(recent) == rewrite_every and len(trees) < params.trees:
                    advanced, before, kept = _advanced(state, recent, len(features), len(targets)), kept, ExitStack()
                    state, recent = kept.enter_context(staged(advanced, "boosting-state")), []
                    before.close()
        finally:
            kept.close()
    return Ensemble(cuts, base, trees)


def predict(
    rows: DataFrame, key: str, features: Sequence[str], names: Sequence[str], model: Ensemble, kept: Sequence[str] = ()
) -> DataFrame:
    """``key``, one score per target and the columns ``kept``, in one pass over the rows."""
    n_features = len(features)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (key, *kept)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            scores = model.scores(_matrix(batch.column(1), n_features))
            own = [batch.column(2 + i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, scores.T), *own], [key, *names, *kept])

    columns = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    schema = [f"`{key}` {kinds[key]}", *(f"`{name}` double" for name in names), *(f"`{c}` {kinds[c]}" for c in kept)]
    own = [F.col(f"`{c}`") for c in kept]
    return rows.select(key, columns.alias("features"), *own).mapInArrow(run, ", ".join(schema))
