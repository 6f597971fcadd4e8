import random
import re

import numpy as np
import pytest

from palate.llm.components import connected_components
from palate.llm.near_dups import Settings, _salted, _sketches_of, components, keep_first, shingle_sets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute_force(texts, words):
    sets = {}
    for doc_id, text in texts.items():
        own = WORDS.findall((text or "").translate(LOWER))
        sets[doc_id] = {tuple(own[i : i + words]) for i in range(max(len(own) - words + 1, 1))} if own else set()
    up = {i: i for i in texts}

    def find(x):
        return x if up[x] == x else find(up[x])

    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in texts}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.fixture
def many(docs_of):
    """Chains of near copies, a large group around one text, a passage that all share, short texts, equal texts."""
    draw = random.Random(4)
    word = lambda: "w%d" % draw.randint(0, 5000)
    passage = [f"p{i}" for i in range(30)]
    texts = {}
    base = [word() for _ in range(60)]
    for i in range(60):
        own = list(base)
        for _ in range(draw.randint(0, 6)):
            own[draw.randrange(60)] = word()
        texts[i] = " ".join(own)
    chain = [word() for _ in range(120)]
    for i in range(60, 80):
        chain[draw.randrange(120)] = word()
        texts[i] = " ".join(chain).upper() if i % 2 else "\t".join(chain)
    for i in range(80, 140):
        texts[i] = " ".join(passage + [word() for _ in range(draw.choice([3, 8, 40]))])
    for i in range(140, 200):
        texts[i] = " ".join(draw.choice("abc") for _ in range(draw.randint(0, 6)))
    texts[200] = texts[201] = texts[5]
    return texts


def test_same_as_brute_force(docs_of, many):
    for words, settings in ((2, Settings(words=2)), (5, Settings(k=12, least_shared=3, block=8, queries=8, rounds=1))):
        docs = docs_of(*many.items())
        assert result(components(docs, settings)) == brute_force(many, words)


def test_defined_results(docs_of, spark):
    docs = docs_of((3, None), (4, ""), (5, " \t\n"), (7, "one"), (6, "ONE"), (None, "one"), (8, "a b"), (8, "a b"))
    rows = components(docs, Settings(words=2)).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    assert found == sorted(
        [
            (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True), (7, 1, 6, False),
            (8, 1, 8, True), (8, 1, 8, True), (None, 1, None, True),
        ],
        key=str,
    )
    assert components(docs.limit(0)).count() == 0


def test_words_are_cut_at_ascii_space_only_and_only_ascii_is_lowered():
    one, two, three = shingle_sets(["É A\x0bb", "É a b", "é a b"], 2)
    assert (one == two).all() and len(set(one) & set(three)) == 1


def test_hashes_do_not_depend_on_the_batch():
    texts = ["some words here", "x", "", "other words ü here " * 50]
    for text, together in zip(texts, shingle_sets(texts, 3), strict=True):
        assert np.array_equal(shingle_sets([text], 3)[0], together)


def test_keep_first_keeps_all_columns(docs_of):
    docs = docs_of((2, "a b c"), (1, "A b C"), (3, "z")).selectExpr("*", "1 AS component", "2 AS kept")
    kept = keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_of_alike_but_unlinked_documents_grow_with_them(docs_of, monkeypatch):
    """However many documents share half of their words, no step makes more than a few rows for each."""
    from palate.llm import near_dups

    draw = random.Random(6)
    template = [f"t{i}" for i in range(80)]
    rows = {}
    stage = near_dups.stage

    def counted(df, label):
        found = stage(df, label)
        rows[label] = max(rows.get(label, 0), found.count())
        return found

    monkeypatch.setattr(near_dups, "stage", counted)
    seen = []
    for n in (200, 400, 800):
        rows.clear()
        texts = []
        for _ in range(n):
            own = list(template)
            for at in draw.sample(range(80), 14):
                own[at] = f"w{draw.randrange(10**6)}"
            texts.append(" ".join(own))
        found = components(docs_of(*enumerate(texts)), Settings(words=2, block=64))
        assert found.where("kept").count() == n
        assert rows["mixed-members"] > 0.9 * n
        seen.append({label: count / n for label, count in rows.items()})
    for label, per_document in seen[-1].items():
        assert per_document <= 1.6 * seen[0].get(label, 0) + 1, (label, seen)


def test_keeping_the_first_moves_no_texts(docs_of, spark):
    docs = docs_of((2, "a b c d e f"), (1, "a b c d e f"), (3, "x y z"), (1, "other words here"), (None, "a b c d e f"))
    docs = docs.select("text", "doc_id", docs["source"].alias("from.where"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        told = keep_first(docs, Settings(words=2))
        moved = keep_first(docs, Settings(words=2, broadcast_rows=0))
        assert "Exchange hashpartitioning" not in told._jdf.queryExecution().executedPlan().toString()
        for kept in (told, moved):
            assert kept.columns == docs.columns
            rows = sorted((r.doc_id or 0, r.text) for r in kept.collect())
            assert rows == [(0, "a b c d e f"), (1, "a b c d e f"), (1, "other words here"), (3, "x y z")]
    finally:
        spark.conf.set(limit, before)


def test_only_sketches_of_pairs_are_moved(spark):
    classes = spark.createDataFrame([(i, [i]) for i in range(10)], "id LONG, sketch ARRAY<LONG>")
    wanted = spark.createDataFrame([(3,), (3,), (7,)], "id LONG")
    assert sorted(r.id for r in _sketches_of(wanted, classes, Settings()).collect()) == [3, 7]
    assert _sketches_of(wanted, classes, Settings(broadcast_rows=0)).count() == 10


def test_only_blocks_with_many_queries_are_cut(spark):
    rows = [(1, i, [0]) for i in range(9)] + [(2, 20, [0]), (1, 0, None), (2, 0, None)]
    cut = _salted(spark.createDataFrame(rows, "block LONG, id LONG, others ARRAY<LONG>"), Settings(queries=3))
    members = sorted((r.block, r.part) for r in cut.where("others is null").collect())
    assert members == [(1, 0), (1, 1), (1, 2), (2, 0)]
    assert cut.where("others is not null").count() == 10
