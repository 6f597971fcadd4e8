import zlib

import numpy as np
import pyarrow as pa
import pytest

from palate.llm import repair

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(tokenizer):
    texts = [
        "The end. THE END, (the end)!", "a<|startoftext|>b c <|endoftext|>", "x\x1cy\x85z q Σας ΑΣ İ ǅ", "", None,
        "  \t\r\n", "don't 'S we'll 12 3.4", "é́ é ́x 日本語。", "<|STARTOFTEXT|> x.", "naïve, naïve. ß.",
    ]
    words = repair.WordTokenizer(PATH, 5)
    for _ in range(3):
        ids, counts = words.encode(pa.array(texts))
        for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert own.tolist() == ids_of(tokenizer, text), text


def test_random_texts_give_the_ids_of_the_library(tokenizer):
    draw = np.random.default_rng(3)
    kinds = ("aB.,", "aİıŉß.,'", "éñüÆœŽ.,!", "ΣσςΑ.,", "日本語。、.", "e\u0301\u0308.,", "ǅǆſK.,", "x1#$%.,<|>", "ﬁﬂªº½²", "abS'.,", "tS'&-###", "é[]{}`~\\^_@?", "ü:;=+*()\"/!")
    others = [chr(c) for c in draw.integers(0xA0, 0x3000, 400)]
    texts = []
    for i in range(10_000):
        letters = list(kinds[i % len(kinds)]) + [" ", "\n", others[draw.integers(len(others))]]
        texts.append("".join(draw.choice(letters, draw.integers(1, 14))))
    words = repair.WordTokenizer(PATH, 100_000)
    wanted = tokenizer.encode_batch(texts, add_special_tokens=False)
    for first in range(0, len(texts), 500):
        ids, counts = words.encode(pa.array(texts[first : first + 500]))
        for text, own, whole in zip(texts[first:], np.split(ids, np.cumsum(counts)[:-1]), wanted[first:]):
            assert own.tolist() == whole.ids, repr(text)


def test_compression_goes_on_until_no_pair_is_frequent():
    draw = np.random.default_rng(2)
    period = draw.permutation(100)
    rules, symbols = repair.compress(np.tile(period, 5000), 200, 16)
    assert len(symbols) < 400  # no pair occurs 16 times in what is left
    for ids in (np.tile(period, 5000), draw.integers(0, 5, 3000), draw.zipf(1.3, 40_000) % 3000, np.zeros(5000, int), np.tile(draw.integers(0, 9, 50), 90)):
        rules, symbols = repair.compress(ids, 5000, 16)
        assert repair.expand(symbols, rules, 5000).tolist() == ids.tolist()
        pairs, counts = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
        # A pair of one symbol overlaps itself, so half of its places may be left.
        assert (counts[pairs[0] != pairs[1]] < 16).all() and (counts < 32).all()
    many = draw.integers(0, 1 << 17, 1 << 19)  # far more pairs than slots, some of them frequent
    many[::8], many[1::8] = 3, 4
    rules, symbols = repair.compress(many, 1 << 18, 16)
    assert (repair.expand(symbols, rules, 1 << 18) == many).all() and [3, 4] in rules.tolist()


def test_equal_rows_are_dealt_to_several_ranges(spark, docs_of, tokenizer):
    rows = [(None, "one and the same text")] * 4000 + [(7, f"text {i}") for i in range(2000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        with_aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        shards = repair.write_shards(docs_of(*rows), repair.Settings(PATH))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_aqe)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert shards.groupBy("range").sum("n_docs").agg({"sum(n_docs)": "max"}).first()[0] < 2000
    found = repair.read_documents(shards).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None] * 4000 + [7] * 2000 and found[-1].start + found[-1].n_tokens == sum(
        r.n_tokens for r in found
    )


@pytest.mark.parametrize("ids", [[], [7], [1, 1, 1, 1, 1], [1, 2] * 500, list(range(300)) * 4])
def test_round_trip_and_random_access(ids):
    ids = np.array(ids, np.int32)
    settings = repair.Settings("", min_count=2)
    sizes = np.array([0, len(ids) // 3, len(ids) - len(ids) // 3])
    shard = repair.Shard(repair.pack([4, None, 9], sizes, ids, 50_000, settings))
    assert shard.doc_ids == [4, None, 9] and shard.n_ids == len(ids)
    assert shard.ids(0, len(ids)).tolist() == ids.tolist()
    for i, (a, b) in enumerate(((0, 0), (0, sizes[1]), (sizes[1], len(ids)))):
        assert shard.document(i).tolist() == ids[a:b].tolist()
    for a in range(0, len(ids), 7):
        assert shard.ids(a, min(a + 5, len(ids))).tolist() == ids[a : a + 5].tolist()
    if len(ids) == 1000:
        assert len(shard.symbols) < 20 and len(shard.rules) >= 5


def test_more_symbols_than_two_bytes_hold():
    ids = np.random.default_rng(1).integers(0, 200, 200_000).astype(np.int32)
    shard = repair.Shard(repair.pack([1], np.array([len(ids)]), ids, 65_530, repair.Settings("", min_count=2)))
    assert shard.symbols.dtype == np.uint32 and (shard.ids(0, len(ids)) == ids).all()


def test_documents_are_read_back_in_order(docs_of, tokenizer):
    rows = [(9, "b a. b a."), (3, None), (5, ""), (5, "same id"), (1, "w " * 3000), (7, "b a. b a.")]
    settings = repair.Settings(PATH, shard_tokens=500, min_count=2)
    shards = repair.write_shards(docs_of(*rows).withColumnRenamed("lang", "range"), settings)
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in repair.read_documents(shards).collect())
    start, expected = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*ids_of(tokenizer, text), 2]
        expected.append((start, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected
    nothing = repair.write_shards(docs_of(*rows).limit(0), settings)
    assert repair.read_documents(nothing).count() == 0
