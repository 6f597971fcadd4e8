"""Quality filter: counts of every text, and a decision list that is learned from labelled documents.

Sequential covering learns an ordered list of conjunctions of thresholds, each of which names low quality. A rule
is grown condition by condition on two thirds of the labelled rows by information gain, its last conditions are
pruned on the other third, and it is kept while it is precise enough there; what it covers is then set aside. The
list becomes one Spark ``CASE WHEN`` over the counts.

Texts are read once, without a shuffle; only counts are joined to labels. The fit sees at most ``max_labelled``
rows, those of smallest hash, so its cost and what the driver holds do not grow with the corpus; all documents are
counted and judged.

Defined results: a null or empty text has no words and fails; labels that are null or of unknown documents are not
used; without labels of both kinds the list is empty and keeps every text that passes the base rules; repeated rows
are separate rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.common import WORD, map_batches, stage

_WORDS = re.compile(WORD)
#: Fixed: the symbols that are counted.
SYMBOLS = "#*$%&|<>"

_COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_caseless", "n_same_as_last", "n_marks",
)
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((name, pa.int64()) for name in _COUNTS)])


def count(text: str | None) -> tuple[int, ...]:
    """The numbers of ``_COUNTS`` for one text."""
    words = _WORDS.findall(text) if text else []
    if not words:
        return (0, 0, sum(map((text or "").count, SYMBOLS)), *(0,) * (len(_COUNTS) - 3))
    numbers: dict[str, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    times = np.bincount(codes)
    distinct = list(numbers)
    upper = np.fromiter(map(str.isupper, distinct), bool, len(distinct))
    lower = np.fromiter(map(str.islower, distinct), bool, len(distinct))
    caseless = np.fromiter(
        (not (u or l) and w.upper() == w.lower() for w, u, l in zip(distinct, upper, lower, strict=True)),
        bool,
        len(distinct),
    )
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(codes, len(numbers)),
        len(lines),
        len(distinct),
        int(times[upper].sum()),
        int(times[caseless].sum()),
        int((codes[1:] == codes[:-1]).sum()),
        text.count("!") + text.count("?"),
    )


def repeated(codes: np.ndarray, n_distinct: int) -> int:
    """Words that lie in a window of three that occurs at least twice."""
    if len(codes) < 4:
        return 0
    pairs = np.unique(codes[:-1] * n_distinct + codes[1:], return_inverse=True)[1]
    _, place, times = np.unique(pairs[:-1] * n_distinct + codes[2:], return_inverse=True, return_counts=True)
    again = times[place] > 1
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every document."""

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            rows = zip(*map(count, part["text"]), strict=True)
            yield {"doc_id": part["doc_id"], **dict(zip(_COUNTS, rows, strict=True))}

    return map_batches(docs, ["doc_id", "text"], run, _SCHEMA)


def features() -> dict[str, Column]:
    """What thresholds are set on."""

    def share(name: str, of: str = "n_words") -> Column:
        return F.coalesce(F.try_divide(F.col(name).cast("double"), F.col(of)), F.lit(0.0))

    return {
        "mean_word_chars": share("word_chars"),
        "symbols_per_word": share("n_symbols"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words"),
        "distinct_share": share("n_distinct"),
        "upper_share": share("n_upper"),
        "caseless_share": share("n_caseless"),
        "same_as_last_share": share("n_same_as_last"),
        "marks_per_word": share("n_marks"),
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    """Low quality if all conditions hold."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        whole = F.lit(True)
        for condition in self.conditions:
            whole = whole & condition.column()
        return whole


@dataclass(frozen=True)
class Learner:
    max_labelled: int = 20_000
    cuts: int = 64
    max_conditions: int = 4
    max_rules: int = 16
    min_precision: float = 0.95
    min_covered: int = 3
    seed: int = 11

    def fit(self, names: Sequence[str], values: np.ndarray, low: np.ndarray) -> list[Rule]:
        """``values`` has a column per name; ``low`` is true for rows of low quality."""
        order = np.random.default_rng(self.seed).permutation(len(low))
        to_prune = np.zeros(len(low), bool)
        to_prune[order[::3]] = True
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, self.cuts + 1)[1:-1])) for column in values.T]
        cuts = [np.unique(np.append(c, np.quantile(v[low], np.linspace(0, 1, 9)))) for c, v in zip(cuts, values.T)]
        left = np.ones(len(low), bool)
        rules: list[Rule] = []
        while len(rules) < self.max_rules and (left & low & ~to_prune).sum() >= self.min_covered:
            steps = self._grow(values, low, left & ~to_prune, cuts)
            steps = self._prune(values, low, left & to_prune, steps)
            if not steps:
                break
            covered = left & self._covers(values, steps)
            if (covered & low).sum() < self.min_covered or low[covered].mean() < self.min_precision:
                break
            rules.append(Rule(tuple(Condition(names[f], above, float(cut)) for f, above, cut in steps)))
            left &= ~covered
        return rules

    @staticmethod
    def _covers(values: np.ndarray, steps: list[tuple[int, bool, float]]) -> np.ndarray:
        covered = np.ones(len(values), bool)
        for feature, above, cut in steps:
            column = values[:, feature]
            covered &= column > cut if above else column <= cut
        return covered

    def _grow(self, values, low, rows, cuts) -> list[tuple[int, bool, float]]:
        steps: list[tuple[int, bool, float]] = []
        inside = np.flatnonzero(rows)
        while len(steps) < self.max_conditions:
            good, bad = int(low[inside].sum()), int((~low[inside]).sum())
            if not good or not bad:
                break
            best = (1e-9, None)
            before = np.log2(good / (good + bad))
            for feature, own in enumerate(cuts):
                place = np.searchsorted(own, values[inside, feature])  # how many cuts lie below the value
                low_at = np.bincount(place[low[inside]], minlength=len(own) + 1)
                high_at = np.bincount(place[~low[inside]], minlength=len(own) + 1)
                low_below, high_below = np.cumsum(low_at)[:-1], np.cumsum(high_at)[:-1]
                for above in (False, True):
                    p, n = (good - low_below, bad - high_below) if above else (low_below, high_below)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = np.where(p >= self.min_covered, p * (np.log2(p / (p + n)) - before), -1.0)
                    at = int(np.argmax(gain)) if len(gain) else -1
                    if at >= 0 and gain[at] > best[0]:
                        best = (gain[at], (feature, above, own[at]))
            if best[1] is None:
                break
            feature, above, cut = best[1]
            seen = values[inside, feature]
            beyond = seen[seen > cut]
            if len(beyond) and len(beyond) < len(seen):
                cut = (seen[seen <= cut].max() + beyond.min()) / 2  # as far from both sides as possible
            steps.append((feature, above, cut))
            inside = inside[self._covers(values[inside], steps[-1:])]
        return steps

    def _prune(self, values, low, rows, steps) -> list[tuple[int, bool, float]]:
        """The shortest beginning of ``steps`` that does best on rows it was not grown on, if it is precise there."""
        best, worth = [], None
        for length in range(1, len(steps) + 1):
            covered = rows & self._covers(values, steps[:length])
            p, n = int((covered & low).sum()), int((covered & ~low).sum())
            if p and p / (p + n) >= self.min_precision and (worth is None or (p - n) / (p + n) > worth + 1e-9):
                best, worth = steps[:length], (p - n) / (p + n)
        return best


def _smallest(hashed: DataFrame, n: int) -> DataFrame:
    """Rows that hold the ``n`` smallest of ``order``, and not many more, so that no task sends ``n`` rows of its own."""
    total = hashed.count()
    share = 1.25 * n / max(total, 1)
    while share < 1:
        few = hashed.where(F.col("order") < F.lit(int((share - 0.5) * 2**64)))
        if few.count() >= n:
            return few
        share *= 2
    return hashed


def learn(counts: DataFrame, labels: DataFrame, learner: Learner) -> list[Rule]:
    """The decision list for ``labels(doc_id, quality)``, 0 being low quality, behind the base rules."""
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", (F.col("quality") == 0).alias("low"))
    own = features()
    labelled = counts.where(~base_failed()).join(known, "doc_id")
    hashed = stage(
        labelled.select("low", *(column.alias(name) for name, column in own.items()), F.xxhash64("doc_id").alias("order")),
        "labelled-counts",
    )
    rows = _smallest(hashed, learner.max_labelled).orderBy("order", "low", *own).limit(learner.max_labelled)
    rows = rows.drop("order").toPandas()
    if rows["low"].nunique() < 2:
        return []
    return learner.fit(list(own), rows[list(own)].to_numpy(float), rows["low"].to_numpy(bool))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdict(rules: Sequence[Rule]) -> Column:
    """True for documents to keep; the first rule that holds decides."""
    decision = F.when(base_failed(), False)
    for rule in rules:
        decision = decision.when(rule.column(), False)
    return decision.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document."""
    counts = stage(measure(docs), "quality-counts")
    rules = learn(counts, labels, learner)
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), verdict(rules).alias("kept"),
    )
