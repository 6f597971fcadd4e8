import numpy as np
from pyspark.sql import functions as F

from palate.llm import language_masks as lm


def test_filter_has_no_false_negatives_and_few_false_positives():
    draw = np.random.default_rng(0)
    known = {str(i): draw.integers(0, 1 << 63, 3000).astype(np.uint64) for i in range(11)}
    model = lm.build(known, lm.Settings())
    for i, name in enumerate(model.languages):
        masks = model.masks(known[name])
        assert ((masks[:, i // 8] >> (i % 8)) & 1).all()
    others = model.masks(draw.integers(0, 1 << 63, 20_000).astype(np.uint64))
    share = (((others[:, 0] >> 3) & 1).mean(), model.false_share[3])
    assert abs(share[0] - share[1]) < 0.003


def test_grams_are_those_of_the_words():
    points, _ = lm.signs(["Ab c"], lm._letters())
    hashed, at = lm.grams(points, 2)
    assert at.tolist() == [0, 1, 2, 3, 4]  # " a", "ab", "b ", " c", "c "
    assert len(lm.grams(points, 3)[0]) == 3  # " ab", "ab ", " c "


def test_held_out_texts_are_recognised(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet".replace("0.001", "0.01"))
    docs = docs.withColumn("held_out", lm.held_out())
    model = lm.train(docs.where("not held_out"))
    found = lm.predict(docs, model, carry=("lang", "held_out")).where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    assert found.where("score < 0 or score > 1 or coverage < 0 or coverage > 1").count() == 0


def test_defined_results(docs_of):
    train = docs_of(*[(i, "der die das und", "de") for i in range(5)], *[(9, "the and of", "en"), (10, "x", None)])
    model = lm.train(train)
    assert model.languages == ("de", "en")
    docs = docs_of((1, None), (2, ""), (3, "123 !?"), (4, "THE and"), (5, "日本"), (None, "und das"), (4, "THE and"))
    rows = [(r.doc_id, r.lang_pred) for r in lm.predict(docs, model).collect()]
    assert sorted(rows, key=str) == sorted(
        [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (None, "de"), (4, "en")], key=str
    )
    nobody = lm.train(train.limit(0))
    assert {r.lang_pred for r in lm.predict(docs, nobody).collect()} == {"und"}
    assert lm.predict(docs.limit(0), model).count() == 0


def test_other_columns_are_kept_even_with_clashing_names(docs_of):
    model = lm.train(docs_of((1, "der die das", "de"), (2, "the and of", "en")))
    docs = docs_of((1, "the and"), (2, None)).withColumn("score", F.lit("mine")).withColumn("extra_0", F.lit(1))
    kept = lm.keep_known(docs, model, 0.1)
    assert kept.columns == docs.columns
    assert [(r.doc_id, r.lang, r.score) for r in kept.collect()] == [(1, "en", "mine")]
