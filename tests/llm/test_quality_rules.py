import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.llm.quality_rules import Learner, count, judge, measure, repeated

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " \n", "a b c", "a b a b a b", "x y z x y z", "one\none\n\n \nONE\none", "# $ # 100% a|b <c> & *", "é\x1cq z w",
    "w " * 60, " ".join(f"w{i}" for i in range(80)), "!!" * 3 + " ABC 12",
]


def base(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    again = {i + j for i, w in enumerate(windows) if w in twice for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(again), failed


def test_counts(docs_of):
    labels = docs_of((0, "")).select("doc_id", F.lit(1).alias("quality")).limit(0)
    rows = judge(docs_of(*enumerate(TEXTS), (9, TEXTS[9])).withColumn("n_words", F.lit("mine")), labels).collect()
    assert len(rows) == len(TEXTS) + 1
    for row in rows:
        assert tuple(row)[1:7] == base(TEXTS[row.doc_id])
        assert row.kept == (not row.base_failed)  # nothing was learned


def test_repeated_words_of_random_texts():
    draw = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 4, 10, 200):
        codes = draw.integers(0, 5, n)
        text = " ".join(f"w{c}" for c in codes)
        assert repeated(np.unique(codes, return_inverse=True)[1], 5) == base(text)[4] == count(text)[4]


def test_learner_finds_conjunctions_in_order():
    draw = np.random.default_rng(0)
    values = draw.random((6000, 3))
    low = ((values[:, 0] > 0.8) & (values[:, 1] <= 0.5)) | (values[:, 2] > 0.95)
    rules = Learner().fit(["a", "b", "c"], values, low)
    found = np.zeros(len(low), bool)
    for rule in rules:
        own = np.ones(len(low), bool)
        for c in rule.conditions:
            column = values[:, "abc".index(c.feature)]
            own &= column > c.threshold if c.above else column <= c.threshold
        found |= own
    assert 2 <= len(rules) <= 4 and (found & ~low).sum() < 30 and (low & ~found).mean() < 0.02
    assert Learner().fit(["a"], values[:, :1], draw.random(6000) < 0.3) == []


def test_held_out_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet".replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{sf}/labels.parquet".replace("0.001", "0.01"))
    test = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    rows = judge(docs, labels.where(~test)).where("not base_failed").join(labels.where(test), "doc_id").collect()
    right = [r.kept == (r.quality == 1) for r in rows]
    assert len(right) > 30 and np.mean(right) > 0.95
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.98


def test_labels_with_nulls_and_empty_tables(docs_of, spark):
    docs = docs_of(*[(i, " ".join(f"w{j}" for j in range(60))) for i in range(20)])
    labels = spark.createDataFrame([(1, None), (2, 0), (2, 1), (99, 0), (None, 0)], "doc_id long, quality int")
    assert all(r.kept for r in judge(docs, labels).collect())
    assert measure(docs.limit(0)).count() == 0


def test_a_bounded_part_of_the_labelled_rows_is_the_same_as_the_first_of_all(spark):
    from palate.llm.quality_rules import _smallest

    hashed = spark.range(20_000).select("id", F.xxhash64("id").alias("order"))
    few = _smallest(hashed, 500)
    assert 500 <= few.count() < 800
    expected = hashed.orderBy("order").limit(500).collect()
    assert few.orderBy("order").limit(500).collect() == expected
    hot = spark.range(3000).select("id", F.when(F.col("id") < 1000, 0).otherwise(F.xxhash64("id")).cast("long").alias("order"))
    assert _smallest(hot, 2900).count() >= 2900 and _smallest(hot, 5000).count() == 3000
