import hashlib
import random
from collections import Counter

import pytest

from palate.llm.suffix_dedup import Settings, digest, removed


def brute_force(texts, length):
    data = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(d[a : a + length] for _, d in data for a in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for a in range(len(d) - length + 1):
            if seen[d[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and (a == 0 or not gone[a - 1]) for a, g in enumerate(gone))
        out.append((i, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    letters = lambda n: "".join(draw.choice("abcdé \n") for _ in range(n))
    passage, other = letters(90), letters(40)
    out = [(1, None), (2, ""), (3, "short"), (4, passage), (5, passage[:-1] + "x"), (6, passage[3:] + other)]
    for i in range(10, 60):
        out.append((i, letters(draw.randint(0, 60)) + passage[draw.randint(0, 9) : draw.randint(60, 90)] + letters(30)))
    out += [(70, "z" * 300), (71, "ab" * 100), (72, other * 5), (73, letters(3000) + other)]
    out += [(80, out[10][1]), (81, out[10][1]), (82, out[12][1]), (82, out[12][1])]
    return out


@pytest.mark.parametrize(
    "settings", [Settings(length=40, gram=9, block=4, piece=64), Settings(length=40, gram=20), Settings(length=41, gram=40, block=1)]
)
def test_same_as_brute_force(docs_of, texts, settings):
    found = sorted((tuple(r) for r in digest(docs_of(*texts), settings).collect()), key=str)
    assert found == brute_force(texts, settings.length)


def test_whole_sample_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in digest(docs).collect()), key=str) == brute_force(texts, 200)


def test_empty_table_and_rows_without_repeats(docs_of):
    docs = docs_of((1, "x" * 250), (2, "short"))
    assert digest(docs.limit(0)).count() == 0
    spans = {r.doc_id: r.spans for r in removed(docs.select("doc_id", "text")).collect()}
    assert spans[2] is None and spans[1]
