"""Maximal repetitions of words: Lyndon arrays by suffix grouping, their roots extended into runs.

A run is a stretch of words with smallest period q, at least ``2 q`` and ``min_length`` words long, that no neighbour
extends. Every run holds a root that is the longest Lyndon word at its start, under the order of words or under the
reversed one. The first phase of grouping suffix sorting finds these words for all positions: suffixes start in groups
by first word; groups are taken from the highest down, and the nearest lower suffix before each member takes the
member's context behind its own, into a new group right above its old one. What a suffix ends up with is its longest
Lyndon prefix, so the arrays of both orders come out of two such passes, without the sort itself. Each root is then
extended to both sides by longest common extensions; those compare names of 2, 4, 8, ... words, equal exactly if the
words are.

Every word of a run lies in a stretch of five words that occurs again in its text (windows of five repeat at distance
q but for those that straddle the middle of a square, and ``min_length`` is 12 or more), so other words are left out
before grouping. Stretches in question of many documents are grouped together, with a lowest word between them that
no common extension passes.

Documents are independent: one Arrow map, no shuffle; a task holds the words of a few documents at once. Work is
linear in the words, times the logarithm of the longest stretch in question.

Defined results: a null or empty text has no words and no runs; words are compared as written; repeated rows are
separate rows; a null ``doc_id`` stays null; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.common import WORD, map_batches

_WORDS = re.compile(WORD)
#: Windows of so many words repeat all over a run.
_WINDOW = 5
#: Words of several documents that are looked at together.
_TOGETHER = 100_000

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
)

Edit = Callable[[int | None, list[str]], list[str]]


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position; 0 ends words and is below everything."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    firsts = np.flatnonzero(np.diff(symbols[order], prepend=symbols[order[0]] - 1)) if n else order
    members = [part.tolist() for part in np.split(order, firsts[1:])] if n else []
    ranks = np.empty(n, np.int64)
    ranks[order] = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, n)))
    group = ranks.tolist()
    length = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    done = [False] * len(members)
    before = list(range(-1, n - 1))  # a position left of which nothing up to this one is lower
    now = len(members) - 1
    while now >= 0:
        done[now] = True
        followers: dict[int, int] = {}
        for place in members[now]:
            if group[place] != now:
                continue
            at = before[place]
            while at >= 0 and done[group[at]]:
                at = before[at]
            # Positions passed on the way need not be passed again.
            step = before[place]
            before[place] = at
            while step > at:
                before[step], step = at, before[step]
            if at >= 0:
                followers[at] = followers.get(at, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for at, times in followers.items():
            moved.setdefault((times, group[at]), []).append(at)
        for (times, old), own in sorted(moved.items(), key=_most_first) if len(moved) > 1 else moved.items():
            new = len(members)
            members.append(own)
            length.append(length[old] + times * length[now])
            done.append(False)
            over = above[old]
            below.append(old)
            above.append(over)
            above[old], below[over] = new, new
            for at in own:
                group[at] = new
        members[now] = ()
        now = below[now]
    return np.fromiter(map(length.__getitem__, group), np.int64, n)


def _most_first(item: tuple[tuple[int, int], list[int]]) -> int:
    return -item[0][0]


class _Names:
    """Names of stretches of 1, 2, 4, ... words; equal names are equal words."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.levels = [symbols]
        while 2 << len(self.levels) <= 2 * longest:
            last, width = self.levels[-1], 1 << (len(self.levels) - 1)
            pairs = last[:-width] * (int(last.max()) + 1) + last[width:]
            self.levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words from ``left`` on equal those from ``right`` on; ``left < right``."""
        left, right, found = left.copy(), right.copy(), np.zeros(len(left), np.int64)
        for level, names in reversed(list(enumerate(self.levels))):
            # A stretch twice as long as the longest name may need this one more than once.
            going = np.ones(len(left), bool)
            while going.any():
                inside = going & (right < len(names))
                going = inside.copy()
                going[inside] = names[left[inside]] == names[right[inside]]
                step = going.astype(np.int64) << level
                left, right, found = left + step, right + step, found + step
        return found

    def common_before(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words that end before ``left`` equal those that end before ``right``; ``left < right``."""
        left, right, found = left.copy(), right.copy(), np.zeros(len(left), np.int64)
        for level, names in reversed(list(enumerate(self.levels))):
            width = 1 << level
            going = np.ones(len(left), bool)
            while going.any():
                inside = going & (left >= width)
                going = inside.copy()
                going[inside] = names[left[inside] - width] == names[right[inside] - width]
                step = going.astype(np.int64) << level
                left, right, found = left - step, right - step, found + step
        return found


def _in_question(words: np.ndarray, texts: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches whose windows of five words occur twice in their text."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    windows = texts[:n]
    for shift in range(_WINDOW):
        pairs = windows * (int(words.max()) + 1) + words[shift : shift + n]
        windows = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    again = (np.bincount(windows)[windows] > 1) & (texts[:n] == texts[_WINDOW - 1 :])
    covered = np.zeros(len(words) + 2, bool)
    for shift in range(_WINDOW):
        covered[1 + shift : 1 + shift + n] |= again
    edges = np.flatnonzero(np.diff(covered.astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    # Stretches of two texts that touch are cut where the second text starts.
    cuts = np.flatnonzero(np.diff(texts)) + 1
    cuts = cuts[covered[cuts] & covered[cuts + 1]]
    starts, ends = np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts))
    long = ends - starts >= min_length
    return starts[long], ends[long]


def runs_of(words: np.ndarray, texts: np.ndarray, min_length: int = 12) -> np.ndarray:
    """Rows ``start, length, period``, by start and period, of the runs of texts that follow each other.

    ``words`` are numbers of words, equal within a text if the words are; ``texts`` ascends from text to text.
    """
    if min_length < 12:
        raise ValueError("shorter runs need not repeat windows of five words")
    starts, ends = _in_question(words, texts, min_length)
    if not len(starts):
        return np.zeros((0, 3), np.int64)
    # All stretches in a row, each followed by an end mark.
    sizes = ends - starts + 1
    offsets = np.cumsum(sizes) - sizes
    origin = np.repeat(starts - offsets, sizes) + np.arange(sizes.sum())
    marks = offsets + sizes - 1
    symbols = np.unique(words[np.minimum(origin, len(words) - 1)], return_inverse=True)[1].astype(np.int64) + 1
    symbols[marks] = 0
    top = int(symbols.max())
    apart = symbols.copy()
    apart[marks] = top + 1 + np.arange(len(marks))  # end marks equal nothing
    names = _Names(apart, int(sizes.max()))
    found = []
    for ranks in (symbols, np.where(symbols > 0, top + 1 - symbols, 0)):
        period = lyndon_lengths(ranks)
        root = np.flatnonzero((symbols > 0) & (np.arange(len(ranks)) + period <= len(ranks)))
        period = period[root]
        after = names.common(root, np.minimum(root + period, len(ranks) - 1))
        before = names.common_before(root, root + period)
        length = before + period + after
        whole = length >= np.maximum(2 * period, min_length)
        found.append(np.stack([origin[root - before], length, period], axis=1)[whole])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _kept(n: int, runs: Sequence[Sequence[int]]) -> np.ndarray:
    """Which of ``n`` words no run contains behind its first period."""
    dropped = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return np.cumsum(dropped[:n]) == 0


def _together(parts: Iterator[dict[str, list]], edit: Edit | None) -> Iterator[tuple[list, list[list[str]]]]:
    """Documents with their words, a bounded number of words or one document at a time."""
    ids, texts, size = [], [], 0
    for part in parts:
        for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
            words = _WORDS.findall(text) if text else []
            words = edit(doc_id, words) if edit else words
            if size and size + len(words) > _TOGETHER:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            size += len(words)
    if ids:
        yield ids, texts


def find(docs: DataFrame, min_length: int = 12, edit: Edit | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` by start and period, and ``collapsed``: the text with each run's first period.

    ``edit`` may replace the words of a document before they are searched.
    """

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for ids, texts in _together(parts, edit):
            numbers: dict[str, int] = {}
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            words = np.fromiter(
                (numbers.setdefault(w, len(numbers)) for own in texts for w in own), np.int64, int(sizes.sum())
            )
            ends = np.cumsum(sizes)
            rows = runs_of(words, np.repeat(np.arange(len(texts)), sizes), min_length)
            cut = np.searchsorted(rows[:, 0], ends)
            runs, collapsed = [], []
            for i, own in enumerate(texts):
                mine = rows[cut[i - 1] if i else 0 : cut[i]] - [ends[i] - sizes[i], 0, 0]
                if len(mine):
                    keep = _kept(len(own), mine)
                    own = [w for w, k in zip(own, keep.tolist(), strict=True) if k]
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()])
                collapsed.append(" ".join(own))
            yield {"doc_id": ids, "n_words": sizes, "runs": runs, "collapsed": collapsed}

    return map_batches(docs, ["doc_id", "text"], run, _SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """One row of figures per row of :func:`find`: its longest run (the first, then the shortest period) and hashes."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["col2"]).alias("start"),
        best["length"].alias("length"),
        (-best["col3"]).alias("period"),
        F.floor(1000 * best["length"] / -best["col3"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words with a repetition in one of ten documents, fixed by the hash of ``doc_id``."""
    code = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, more = len(words), code // 10
    if doc_id is None or code % 10 or not n:
        return words
    first = more % n
    period = 1 + (n - first) // (3 + more % 8)
    return words[:first] + [words[first + i % period] for i in range(n - first)]
