import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.llm.periodic_runs import digest, find, lyndon_lengths, planted, runs_of


def brute_runs(words, least=12):
    """All runs by comparing words at every distance; the smallest period of a stretch wins."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(least, 2 * q) and end > start:
                found.setdefault((start, end + q - start), q)
            start = end + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_lyndon(symbols):
    out = []
    for i in range(len(symbols)):
        j = i + 1
        while j < len(symbols) and symbols[j:] > symbols[i:]:
            j += 1
        out.append(j - i)
    return out


def random_words(draw):
    words = draw.integers(0, draw.integers(1, 6), draw.integers(0, 60)).tolist()
    for _ in range(draw.integers(0, 3)):
        period = draw.integers(0, 9, draw.integers(1, 12)).tolist()
        at = draw.integers(0, len(words) + 1)
        words[at:at] = (period * 9)[: draw.integers(2, 60)]
    return words


def test_lyndon_lengths():
    draw = np.random.default_rng(0)
    assert len(lyndon_lengths(np.zeros(0, np.int64))) == 0
    for _ in range(400):
        symbols = [s + 1 for s in random_words(draw)]
        assert lyndon_lengths(np.array([*symbols, 0]))[:-1].tolist() == brute_lyndon(symbols)


def test_runs_of_random_words():
    draw = np.random.default_rng(1)
    for _ in range(600):
        texts = [random_words(draw) for _ in range(draw.integers(1, 4))]
        words = np.array([w for own in texts for w in own], np.int64)
        place = np.repeat(np.arange(len(texts)), [len(own) for own in texts])
        expected, offset = [], 0
        for own in texts:
            expected += [[s + offset, length, q] for s, length, q in brute_runs(own)]
            offset += len(own)
        assert runs_of(words, place).tolist() == expected, texts
    with pytest.raises(ValueError):
        runs_of(np.zeros(9, np.int64), np.zeros(9, np.int64), 6)


def expected_row(doc_id, text):
    words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), s, length, q, 1000 * length // q if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest(),
    )


TEXTS = [
    None, "", " \n ", "a", "a " * 11, "a " * 12, "a b " * 6, "a b " * 5 + "a", "x y z " * 20 + "x q", "é\x1cß é\x1cß " * 8,
    "a b c d e f a b c d e f", "a a b a a b a a b a a b a a b c a a b", "w " * 40 + "v " * 40 + "w v " * 20,
]


def test_texts_and_odd_rows(docs_of):
    draw = np.random.default_rng(2)
    texts = TEXTS + [" ".join(f"w{w}" for w in random_words(draw)) for _ in range(150)]
    rows = [*enumerate(texts), (5, TEXTS[5]), (5, TEXTS[8]), (None, TEXTS[6])]
    docs = docs_of(*rows).withColumn("runs", F.lit("mine")).withColumn("n_words", F.lit(None))
    found = sorted(map(tuple, digest(find(docs, edit=planted)).collect()), key=str)
    assert found == sorted((expected_row(*row) for row in rows), key=str)
    assert find(docs.limit(0)).count() == 0


def test_operator_without_edit(docs_of):
    docs = docs_of((0, "q " + "a b " * 8 + "z"), (1, "plain words"))
    first, second = sorted(find(docs).collect())
    assert first.collapsed == "q a b z" and [tuple(r) for r in first.runs] == [(1, 16, 2)]
    assert second.collapsed == "plain words" and second.runs == []


def test_very_long_text(docs_of):
    words = [f"w{i % 997}" for i in range(300_000)] + ["end"] + [f"v{i}" for i in range(100_000)]
    row = find(docs_of((0, " ".join(words)))).first()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 997)]
    assert row.collapsed.split(" ") == words[:997] + words[300_000:]


def test_planted_follows_the_hash():
    words = [f"w{i}" for i in range(100)]
    hit = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    miss = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    assert planted(miss, words) == words and planted(hit, []) == [] and planted(None, words) == words
    more = zlib.crc32(str(hit).encode()) // 10
    a = more % 100
    p = 1 + (100 - a) // (3 + more % 8)
    assert planted(hit, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(100)]


def test_query_on_a_whole_table(spark, sf):
    from palate.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = {row.doc_id: tuple(row) for row in QUERIES["op12_lyndon_runs"](spark, sf).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs:
        if len((text or "").split()) < 1500:
            assert found[doc_id] == expected_row(doc_id, text)
