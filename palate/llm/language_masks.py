"""Language identification: a bit-sliced Bloom filter that answers, per n-gram, with a bitmask of languages.

Training takes a bounded sample of labelled texts per language and keeps the ``top`` most frequent n-grams of each
order. Row ``r`` of the filter holds one bit per language; an n-gram's mask is the AND of the rows its hashes name,
so one lookup tells every language that has the n-gram. A text gets a popcount per language. A filter with share
``f`` of its bits set gives ``f ** hashes`` false positives, which are taken off the count; the language with most
remaining hits wins, the first in alphabetical order if several do. ``score`` is its share of all languages' hits,
``coverage`` its share of the text's n-grams.

N-grams are of lower-case letters; a space stands for anything else and may only be their first or last sign. The
filter has a fixed size, whatever the corpus; texts are read once, without a shuffle.

Defined results: ``und`` with score 0 if the text is null or has no letter, or nothing was learned; a text with
letters but no known n-gram gets the first language with score 0; rows without a language are not trained on;
repeated rows are separate rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palate.llm.common import map_batches, own_names, plain_names, unit_hash

UNKNOWN = "und"
_SMALL = 0x3000  # signs below it are looked up in a table


@dataclass(frozen=True)
class Settings:
    """The sample has about ``sample`` texts of each language, of all its texts if there are fewer."""

    sample: int = 600
    orders: tuple[int, ...] = (2, 3, 4, 5)
    top: int = 3000
    bits: int = 17
    hashes: int = 3
    seed: int = 7


@dataclass(frozen=True)
class Filter:
    """``rows[r]`` has the languages' bits of row ``r``, eight to a byte; ``false_share`` one number per language."""

    languages: tuple[str, ...]
    rows: np.ndarray
    false_share: np.ndarray
    settings: Settings

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """One row of bytes per n-gram."""
        found = None
        for place in _places(grams, self.settings):
            rows = self.rows[place]
            found = rows if found is None else found & rows
        return found


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(_SMALL)), bool, _SMALL)


def signs(texts: Sequence[str | None], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, 0 for what is not a letter, and where each text ends; each is framed by zeros."""
    lowered = [(text or "").lower() for text in texts]
    points = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "replace"), "<u4")
    letter = np.zeros(len(points), bool)
    small = points < _SMALL
    letter[small] = is_letter[points[small]]
    if not small.all():
        others, place = np.unique(points[~small], return_inverse=True)
        letter[~small] = np.fromiter((chr(c).isalpha() for c in others), bool, len(others))[place]
    ends = np.cumsum([len(text) + 1 for text in lowered])
    return np.where(letter, points, 0).astype(np.uint64), ends


def grams(points: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of one order, and the places where they begin."""
    n = len(points) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashed = points[:n] + np.uint64(order)
    for i in range(1, order):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + points[i : i + n]
    valid = (points[:n] > 0) | (points[1 : n + 1] > 0) if order == 2 else np.ones(n, bool)
    for i in range(1, order - 1):
        valid &= points[i : i + n] > 0
    at = np.flatnonzero(valid)
    hashed = hashed[at]
    hashed ^= hashed >> np.uint64(32)
    return hashed * np.uint64(0xD6E8FEB86659FD93), at


def _places(hashed: np.ndarray, settings: Settings) -> Iterator[np.ndarray]:
    first = hashed >> np.uint64(64 - settings.bits)
    step = (hashed >> np.uint64(8)) | np.uint64(1)
    for j in range(settings.hashes):
        yield ((first + step * np.uint64(j)) & np.uint64((1 << settings.bits) - 1)).astype(np.int64)


def build(top_grams: dict[str, np.ndarray], settings: Settings) -> Filter:
    """A filter of the given n-gram hashes of each language."""
    languages = tuple(sorted(top_grams))
    rows = np.zeros((1 << settings.bits, (len(languages) + 7) // 8 or 1), np.uint8)
    false_share = np.zeros(len(languages))
    for i, language in enumerate(languages):
        own = np.unique(np.concatenate(list(_places(top_grams[language], settings))))
        rows[own, i // 8] |= np.uint8(1 << (i % 8))
        false_share[i] = (len(own) / len(rows)) ** settings.hashes
    return Filter(languages, rows, false_share, settings)


def train(docs: DataFrame, settings: Settings = Settings()) -> Filter:
    """Learn from ``doc_id, text, lang`` of the given rows; ``doc_id`` only draws the sample."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return build({}, settings)
    share = F.lit(0.0)
    for language, size in sizes.items():
        share = F.when(F.col("lang") == language, settings.sample / size).otherwise(share)
    sample = labelled.where(unit_hash("doc_id", seed=settings.seed) < share)
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        is_letter = _letters()
        for part in parts:
            for language in set(part["lang"]):
                texts = [t for t, own in zip(part["text"], part["lang"], strict=True) if own == language]
                points, _ = signs(texts, is_letter)
                for order in settings.orders:
                    found, n = np.unique(grams(points, order)[0].view(np.int64), return_counts=True)
                    yield {"lang": [language] * len(found), "size": [order] * len(found), "gram": found, "n": n}

    counted = map_batches(sample, ["text", "lang"], run, schema).groupBy("lang", "size", "gram")
    best_first = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    top = (
        counted.agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") <= settings.top)
        .select("lang", "gram")
        .toPandas()
    )
    return build({k: v["gram"].to_numpy().view(np.uint64) for k, v in top.groupby("lang")}, settings)


_SCHEMA = [("lang_pred", pa.string()), ("score", pa.float64()), ("coverage", pa.float64())]


def predict_texts(texts: Sequence[str | None], model: Filter, is_letter: np.ndarray) -> list[tuple[str, float, float]]:
    points, ends = signs(texts, is_letter)
    n_langs = len(model.languages)
    if not n_langs:
        return [(UNKNOWN, 0.0, 0.0)] * len(texts)
    bit = (np.arange(256)[:, None] >> np.arange(8)) & 1
    hits = np.zeros((len(texts), n_langs))
    total = np.zeros(len(texts))
    for order in model.settings.orders:
        hashed, at = grams(points, order)
        of_text = np.searchsorted(ends, np.arange(len(points)), "right").clip(max=len(texts) - 1)[at]
        total += np.bincount(of_text, minlength=len(texts))
        masks = model.masks(hashed)
        for byte in range(masks.shape[1]):
            table = np.bincount((of_text << 8) | masks[:, byte], minlength=len(texts) << 8).reshape(len(texts), 256)
            hits[:, byte * 8 : byte * 8 + 8] += (table @ bit)[:, : n_langs - byte * 8]
    real = np.maximum(hits - model.false_share * total[:, None], 0) / (1 - model.false_share)
    has_letter = np.add.reduceat(points > 0, np.append(0, ends[:-1]), dtype=np.int64) > 0
    best = real.argmax(axis=1)
    won = real[np.arange(len(texts)), best]
    score = np.divide(won, real.sum(axis=1), out=np.zeros(len(texts)), where=won > 0)
    coverage = np.divide(won, total, out=np.zeros(len(texts)), where=total > 0).clip(max=1)
    return [
        (model.languages[b], float(s), float(c)) if known else (UNKNOWN, 0.0, 0.0)
        for b, s, c, known in zip(best, score, coverage, has_letter, strict=True)
    ]


def predict(docs: DataFrame, model: Filter, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``lang_pred, score, coverage`` of every text behind the columns to carry along."""
    schema = pa.schema([*((c, _arrow_type(docs, c)) for c in carry), *_SCHEMA])
    columns = list(dict.fromkeys([*carry, "text"]))

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        is_letter = _letters()
        for part in parts:
            found = predict_texts(part["text"], model, is_letter)
            answers = dict(zip((name for name, _ in _SCHEMA), zip(*found, strict=True), strict=True))
            yield {c: part[c] for c in carry} | answers

    return map_batches(docs, columns, run, schema, rows=256)


def keep_known(docs: DataFrame, model: Filter, least_coverage: float) -> DataFrame:
    """Rows whose language is found and knows enough of the text; ``lang`` becomes that language."""
    plain, names = plain_names(docs, ["text", "lang"])
    found = predict(plain, model, carry=plain.columns)
    known = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("coverage") >= least_coverage))
    return own_names(known.withColumn("lang", F.col("lang_pred")), names)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def held_out(column: str = "doc_id"):
    """True for the quarter of the documents that training leaves out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
