"""Bytes covered by a repeated window of ``length`` bytes, by a depth-limited radix sort of suffixes.

Suffixes are told apart by their first ``length`` bytes only, most significant digit first, and a suffix that stands
alone after a digit is dropped. Digits are taken so that few suffixes have to be written down:

1. The first digit of a window is its minimizer, the ``gram`` bytes in it with the smallest hash. Neighbouring
   windows share theirs, so a run of windows is one row. Grams that occur once are dropped, with all their windows.
2. The second digit is the whole stretch of bytes that a run covers. Runs of one gram with equal stretches are
   repeated in all their windows.
3. For grams with several stretches, windows are taken by ``block`` neighbours that stand at the same distances from
   the gram. The third digit is what all windows of a block share; the fourth is the stretch the block covers.
4. The last digit, only where blocks share the third digit and differ in the fourth, is the window itself.

Equal windows have equal digits, so the groups that are left are exactly the repeated windows. Digits travel as
64-bit hashes. Every count is summed before it is shuffled, and rows come back to their counts by joins that may
split a hot digit. A task holds a bounded piece of text or one document.

Matches do not cross documents. Defined results: a null text is empty, and texts below ``length`` bytes lose
nothing; repeated rows are copies of each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.common import map_batches, stage


@dataclass(frozen=True)
class Settings:
    length: int = 200
    gram: int = 40
    block: int = 16
    piece: int = 1 << 20


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE_BITS = np.uint64(24)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


class _Hasher:
    """Hashes of stretches of bytes from running sums of ``byte * factor ** place``."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.down = np.full(n + 1, _INVERSE)
        self.down[:1] = 1
        self.down = np.cumprod(self.down)
        up = np.full(n, _FACTOR)
        up[:1] = 1
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * np.cumprod(up), out=self.sums[1:])

    def every(self, size: int) -> np.ndarray:
        """Hashes of all stretches of one size."""
        return _mix((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])

    def some(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def _pieces(texts: Sequence[bytes], settings: Settings) -> Iterator[tuple[np.ndarray, list[int], np.ndarray, np.ndarray]]:
    """Bytes of about ``piece`` at a time: the bytes, which text each part is of, its start there, and part ends.

    Parts of a long text overlap by less than a window, so each window lies in exactly one part.
    """
    whose: list[int] = []
    at: list[int] = []
    parts: list[bytes] = []
    held = 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - settings.length + 1, 0), settings.piece):
            part = text[start : start + settings.piece + settings.length - 1]
            whose.append(i)
            at.append(start)
            parts.append(part)
            held += len(part)
            if held >= settings.piece:
                yield np.frombuffer(b"".join(parts), np.uint8), whose, np.array(at), np.cumsum([len(p) for p in parts])
                whose, at, parts, held = [], [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), whose, np.array(at), np.cumsum([len(p) for p in parts])


def _runs(data: np.ndarray, ends: np.ndarray, settings: Settings) -> tuple[np.ndarray, ...]:
    """``part, first, last window, anchor, gram hash, stretch hash`` of each run of windows with one minimizer."""
    hasher = _Hasher(data)
    grams = hasher.every(settings.gram)
    keys = ((grams >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width = settings.length - settings.gram + 1
    least, span = keys, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    anchors = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    part = np.searchsorted(ends, np.arange(len(anchors)), "right")
    inside = np.arange(len(anchors)) + settings.length <= ends[part]
    new = np.append(True, (anchors[1:] != anchors[:-1]) | (part[1:] != part[:-1])) & inside
    first = np.flatnonzero(new)
    # A run ends before the next one, or where its part has no more windows.
    last = np.minimum(np.append(first[1:], len(anchors)) - 1, ends[part[first]] - settings.length)
    anchor = anchors[first]
    stretch = hasher.some(first, last + settings.length)
    stretch = _mix(stretch + (last - first).astype(np.uint64) * _FACTOR) + (anchor - first).astype(np.uint64)
    return part[first], first, last, anchor, grams[anchor], _mix(stretch)


def _key() -> Column:
    """Names a row; equal rows share it."""
    return F.xxhash64("doc_id", "text")


_RUNS = pa.schema(
    [
        ("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("anchor", pa.int32()),
        ("gram", pa.int64()), ("stretch", pa.int64()),
    ]
)


def runs(docs: DataFrame, settings: Settings) -> DataFrame:
    """One row per run of windows: where it starts, how many windows it has, and its first two digits."""

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for batch in parts:
            texts = [text.encode("utf-8", "surrogatepass") for text in batch["text"]]
            keys = np.array(batch["key"], np.int64)
            for data, whose, at, ends in _pieces(texts, settings):
                part, first, last, anchor, gram, stretch = _runs(data, ends, settings)
                begins = np.append(0, ends[:-1])
                yield {
                    "key": keys[np.array(whose)[part]],
                    "start": first - begins[part] + at[part],
                    "windows": last - first + 1,
                    "anchor": anchor - begins[part] + at[part],
                    "gram": gram.view(np.int64),
                    "stretch": stretch.view(np.int64),
                }

    long_enough = docs.where(F.octet_length("text") >= settings.length)
    return map_batches(long_enough.select(_key().alias("key"), "text"), ["key", "text"], run, _RUNS, rows=256)


def _with_runs(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """``key, text, runs`` of the texts that hold one of the wanted runs; equal texts once."""
    columns = [F.col(c) for c in wanted.columns if c != "key"]
    per_text = wanted.groupBy("key").agg(F.collect_list(F.struct(*columns)).alias("runs"))
    texts = docs.where(F.octet_length("text") >= settings.length).select(_key().alias("key"), "text")
    return texts.join(per_text, "key").dropDuplicates(["key"])


def _hashed(batch: dict[str, list], length: int) -> Iterator[tuple[int, list[dict], int, _Hasher]]:
    """Of each text, up to 4096 of its runs at a time, and a hasher of the bytes around them that begin at an offset."""
    for key, text, own in zip(batch["key"], batch["text"], batch["runs"], strict=True):
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        own = sorted(own, key=lambda r: r["start"])
        for at in range(0, len(own), 4096):
            few = own[at : at + 4096]
            low = few[0]["start"]
            high = max(r["start"] + r["windows"] for r in few) + length
            yield key, few, low, _Hasher(data[low:high])


def _column(rows: list[dict], name: str) -> np.ndarray:
    return np.array([r[name] for r in rows])


def _spread(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(firsts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


_BLOCKS = pa.schema(
    [
        ("shared", pa.int64()), ("stretch", pa.int64()), ("key", pa.int64()), ("start", pa.int32()),
        ("windows", pa.int32()), ("alone", pa.bool_()),
    ]
)


def _blocks(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """The third and fourth digit of every block of the wanted runs (``key, start, windows, anchor, alone``)."""
    size, length = settings.block, settings.length

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for batch in parts:
            for key, few, low, hasher in _hashed(batch, length):
                first, windows, anchor = (_column(few, c) for c in ("start", "windows", "anchor"))
                # Blocks by distance of a window's start from the anchor, farthest first.
                far, near = (anchor - first) // size, (anchor - first - windows + 1) // size
                counts = far - near + 1
                which = np.repeat(np.arange(len(few)), counts)
                block = far[which] - _spread(np.zeros(len(few), np.int64), counts)
                nearest = anchor[which] - block * size  # the last start that a full block has
                start = np.maximum(nearest - size + 1, first[which])
                last = np.minimum(nearest, (first + windows - 1)[which])
                shared = hasher.some(nearest - low, nearest - size + 1 + length - low)
                shared = _mix(shared + block.astype(np.uint64) * _FACTOR)
                whole = hasher.some(start - low, last + length - low)
                whole = _mix(_mix(whole + (last - start).astype(np.uint64) * _FACTOR) + (nearest - start).astype(np.uint64))
                yield {
                    "shared": shared.view(np.int64),
                    "stretch": whole.view(np.int64),
                    "key": np.full(len(start), key),
                    "start": start,
                    "windows": last - start + 1,
                    "alone": _column(few, "alone")[which],
                }

    return map_batches(_with_runs(docs, wanted, settings), ["key", "text", "runs"], run, _BLOCKS, rows=64)


_WINDOWS = pa.schema([("window", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("alone", pa.bool_())])


def _windows(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """The last digit of every window of the wanted runs (``key, start, windows, alone``)."""
    length = settings.length

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for batch in parts:
            for key, few, low, hasher in _hashed(batch, length):
                sizes = _column(few, "windows")
                place = _spread(_column(few, "start"), sizes)
                yield {
                    "window": hasher.some(place - low, place - low + length).view(np.int64),
                    "key": np.full(len(place), key),
                    "start": place,
                    "alone": np.repeat(_column(few, "alone"), sizes),
                }

    return map_batches(_with_runs(docs, wanted, settings), ["key", "text", "runs"], run, _WINDOWS, rows=64)


def _radix_pass(rows: DataFrame, digit: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Drop rows that stand alone in a digit, and tell the others by their ``stretch``.

    First come rows that are repeated as a whole; second, for digits with several stretches, one row per stretch,
    ``alone`` if nothing equals it so far. ``rows`` has ``key, start, windows, stretch`` and may have ``alone``.
    """
    alone = F.col("alone") if "alone" in rows.columns else F.lit(True)
    rows = rows.withColumn("alone", alone)
    digits = (
        rows.groupBy(digit)
        .agg(F.count(F.lit(1)).alias("n"), F.min("stretch").alias("low"), F.max("stretch").alias("high"))
        .where("n > 1")
        .select(digit, (F.col("low") != F.col("high")).alias("mixed"))
    )
    # Staged, so that adaptive execution may split the rows of a hot digit.
    digits = stage(digits, f"{label}-digits")
    again = stage(rows.join(digits, digit), f"{label}-again")
    plain = again.where("not mixed and alone").select("key", "start", "windows")
    mixed = again.where("mixed")
    carried = [c for c in rows.columns if c not in ("stretch", "alone", digit)]
    stretches = stage(
        mixed.groupBy(digit, "stretch").agg(
            F.count(F.lit(1)).alias("n"), F.bool_and("alone").alias("alone"), F.min(F.struct(*carried)).alias("first")
        ),
        f"{label}-stretches",
    )
    equal = mixed.where("alone").join(stretches.where("n > 1").select(digit, "stretch"), [digit, "stretch"])
    whole = plain.unionByName(equal.select("key", "start", "windows"))
    left = stretches.select("first.*", (F.col("alone") & (F.col("n") == 1)).alias("alone"))
    return whole, left


def repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``key, start, end`` of stretches whose windows all occur elsewhere; together they hold all such windows."""
    by_run, left = _radix_pass(stage(runs(docs, settings), "suffix-runs"), "gram", "suffix-run")
    by_block, left = _radix_pass(stage(_blocks(docs, left, settings), "suffix-blocks"), "shared", "suffix-block")
    windows = stage(_windows(docs, left, settings), "suffix-windows")
    twice = (
        windows.groupBy("window")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or("alone").alias("open"))
        .where("n > 1 and open")
        .select("window")
    )
    twice = stage(twice, "suffix-twice")
    single = windows.where("alone").join(twice, "window").select("key", "start", F.lit(1).alias("windows"))
    found = by_run.select("key", "start", "windows").unionByName(by_block).unionByName(single)
    end = F.col("start") + F.col("windows") + settings.length - 1
    return stage(found.select("key", "start", end.alias("end")).distinct(), "suffix-repeats")


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)


def spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal stretches that the given ones cover, in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def removed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All rows of ``docs(doc_id, text)`` and ``spans``, the ``start, end`` of repeats by byte."""
    own = repeats(docs, settings).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return docs.withColumn("key", _key()).join(own, "key", "left").drop("key")


def digest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    found = removed(docs.select("doc_id", "text"), settings)

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for batch in parts:
            rows = []
            for doc_id, text, own in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                if not own:
                    rows.append((doc_id, len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    continue
                starts, ends = spans(np.array([s["start"] for s in own]), np.array([s["end"] for s in own]))
                kept, at = hashlib.sha256(), 0
                for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                rows.append((doc_id, len(data), int((ends - starts).sum()), len(starts), kept.hexdigest()))
            yield dict(zip(_RESULT.names, zip(*rows, strict=True), strict=True))

    return map_batches(found, ["doc_id", "text", "spans"], run, _RESULT, rows=256)


#: The same for windows of 200 bytes. Texts are cut into pieces first, as taking a part of a long text costs its length.
ORACLE_SQL = """
WITH bytes AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
pieces AS (
  SELECT doc_id, n, p, substr(h, 2 * p + 1, 2 * 327) AS h FROM (
    SELECT doc_id, n, h, unnest(range(0, n - 199, 128)) AS p FROM bytes WHERE n >= 200)
),
windows AS (
  SELECT doc_id, p + i AS i, md5_number(substr(h, 2 * i + 1, 400)) AS k FROM (
    SELECT doc_id, p, h, unnest(range(0, least(128, n - 199 - p))) AS i FROM pieces)
),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
hits AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows SEMI JOIN twice USING (k)
),
runs AS (
  SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits
),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY ALL),
gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM spans
),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS front,
    max(b) AS last, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)"""
