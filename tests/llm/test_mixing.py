import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from palate.llm import mixing
from palate.llm.mixing import Settings, draw, hypergeometric, summary


def water_fill(words, most=3):
    """Targets by resharing until none is above its limit."""
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, full = sum(words.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(most * words[s] for s in full)
        over = {s for s in rest if left * weight[s] / sum(weight[r] for r in rest) > most * words[s]}
        if not over:
            return {s: most * words[s] if s in full else left * weight[s] / sum(weight[r] for r in rest) for s in order}
        full |= over


@pytest.fixture
def uneven(docs_of):
    rows = [(i, "w " * (i % 7 + 1), "en", "s%02d" % (i % 11)) for i in range(1500)]
    rows += [(2000 + i, "x " * 5, "en", "hot") for i in range(1500)] + [(5000, "t " * 3, "en", "tiny")]
    rows += [(6000 + i, "n n", "en", None) for i in range(200)] + [(7000, None, "en", "s01"), (7001, "", "en", "s02")]
    return docs_of(*rows)


def test_targets_and_what_is_taken(uneven):
    rows = summary(uneven, Settings(block_docs=8)).collect()
    source = {r.doc_id: r.source for r in uneven.collect()}
    size = {r.doc_id: len((r.text or "").split()) for r in uneven.collect()}
    words, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.taken in {r["size"] * i for i in range(4)}
        words[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
    targets = water_fill(words)
    assert len(rows) == len(source) and math.isclose(sum(targets.values()), sum(words.values()))
    for r in rows:
        own = source[r.doc_id]
        assert r.source_size == words[own] and math.isclose(r.target, targets[own], rel_tol=1e-9)
        assert abs(taken[own] - targets[own]) <= 7
        assert r["size"] == 0 or len(r.shards) == r.taken // r["size"]


def test_reruns_and_partitionings_agree(uneven):
    def rows(docs):
        return sorted(tuple(r) for r in summary(docs, Settings(shard_words=500)).collect())

    assert rows(uneven) == rows(uneven.repartition(7, "n_chars"))


def test_shards_have_equal_shares_of_draws(uneven):
    settings = Settings(shard_words=500, block_docs=8)
    planned = mixing.plan(uneven, settings).collect()
    shards = Counter(s for r in planned for s in r.shards)
    n = math.ceil(sum(r.words for r in {r.source: r for r in planned}.values()) / 500)
    draws = sum(shards.values())
    assert set(shards) == set(range(n))
    assert all(math.floor(draws / n) <= count <= math.ceil(draws / n) for count in shards.values())


def test_draw_repeats_rows_and_keeps_columns(uneven):
    docs = uneven.withColumn("__plan", F.lit(1)).withColumn("size", F.lit("mine"))
    mixed = draw(docs)
    times = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns
    assert times == {r.doc_id: len(r.shards) for r in summary(uneven).collect() if len(r.shards)}


def test_hypergeometric_draws_have_its_distribution(spark):
    good, total, drawn, n = 30, 100, 20, 4000
    sql = hypergeometric(str(good), str(total), str(drawn), "u")
    found = Counter(
        r[0] for r in spark.range(n).selectExpr(f"(id + 0.5D) / {n} AS u").select(F.expr(sql)).collect()
    )
    for k in range(0, 21):
        share = math.comb(good, k) * math.comb(total - good, drawn - k) / math.comb(total, drawn)
        assert abs(found[k] - n * share) <= 1.5
    edge = spark.range(1).select(*[F.expr(hypergeometric(*map(str, c), "0.5D")) for c in ((0, 9, 4), (9, 9, 4), (5, 9, 9), (5, 9, 0))])
    assert tuple(edge.first()) == (0, 4, 5, 0)
    large = spark.range(1).select(F.expr(hypergeometric("4000000", "9000000", "4500000", "0.5D"))).first()[0]
    assert abs(large - 2_000_000) <= 2


def test_edges(docs_of):
    assert summary(docs_of((1, "a")).limit(0)).count() == 0
    only_empty = summary(docs_of((1, None), (2, "", "en", None))).collect()
    assert [(r["size"], r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)] * 2
    same = summary(docs_of((1, "a b"), (1, "a b"), (None, "c"))).collect()
    by_id = defaultdict(set)
    for r in same:
        by_id[r.doc_id].add(r.taken)
    assert len(same) == 3 and len(by_id[1]) == 1


def test_blocks_without_words_use_up_no_draws(docs_of):
    rows = [(i, None, "en", "a") for i in range(600)] + [(1000 + i, "w " * 10, "en", "a") for i in range(40)]
    rows += [(2000 + i, "x " * 10, "en", "b") for i in range(40)]
    docs = docs_of(*rows)
    settings = Settings(block_docs=4)
    for row in mixing.plan(docs, settings).collect():
        once_more = row.cut is not None or bool(row.extra)
        assert len(row.shards) == row.full + once_more
    found = summary(docs, settings).collect()
    for low, source in ((0, "a"), (2000, "b")):
        own = [r for r in found if low <= r.doc_id < low + 2000]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10, source
