import random
from collections import Counter

from palate.llm.bestfit import Settings, best_fit, pack


def scan_all_bins(pieces, capacity):
    bins, placed = [], []
    for size, source, cluster in pieces:
        fits = [
            (capacity - b[0], i)
            for i, b in enumerate(bins)
            if capacity - b[0] >= size and not (b[1] & source or b[2] & cluster)
        ]
        own = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([0, 0, 0])
        bins[own] = [bins[own][0] + size, bins[own][1] | source, bins[own][2] | cluster]
        placed.append(own)
    return placed


def test_search_finds_the_tightest_compatible_bin():
    draw = random.Random(1)
    for _ in range(100):
        pieces = [(draw.randint(1, 50), 1 << draw.randint(0, 3), 1 << draw.randint(0, 9)) for _ in range(60)]
        assert best_fit(pieces, 50) == scan_all_bins(pieces, 50)


def test_all_words_are_packed_without_conflicts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = pack(docs, Settings(capacity=300, shard_pieces=64)).collect()
    source = {d.doc_id: d.source for d in docs.collect()}
    words = {d.doc_id: len((d.text or "").split()) for d in docs.collect()}
    filled, seen, packed = Counter(), set(), Counter()
    for row in rows:
        filled[row.bin] += row.n_words
        packed[row.doc_id] += row.n_words
        assert (row.bin, source[row.doc_id]) not in seen
        seen.add((row.bin, source[row.doc_id]))
    assert max(filled.values()) <= 300
    assert dict(packed) == words


def test_nulls_empty_texts_and_equal_rows(docs_of):
    docs = docs_of((1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "a b c", "en", None), (4, "x " * 25))
    rows = sorted(tuple(r)[2:] + (r.bin is None,) for r in pack(docs, Settings(capacity=10)).collect() if r.doc_id)
    assert rows == [
        (1, 0, 0, 0, True), (2, 0, 0, 0, True), (3, 0, 0, 3, False), (3, 1, 0, 3, False),
        (4, 0, 0, 10, False), (4, 0, 10, 10, False), (4, 0, 20, 5, False),
    ]
    bins = [r.bin for r in pack(docs, Settings(capacity=10)).collect() if r.doc_id == 3]
    assert len(set(bins)) == 2  # copies share a cluster


def test_a_named_cluster_keeps_documents_apart(docs_of):
    docs = docs_of((1, "a b", "x", "s"), (2, "c d", "x", "t"), (3, "e f", "y", "u"))
    together = pack(docs, cluster="lang").collect()
    bins = {r.doc_id: r.bin for r in together}
    assert bins[1] != bins[2] and bins[3] in (bins[1], bins[2])


def test_empty_table(docs_of):
    assert pack(docs_of((1, "a")).limit(0)).count() == 0
