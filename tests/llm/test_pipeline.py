import re
from collections import Counter

import corpus_pipeline
import pytest

from palate.llm import secret_index
from palate.llm.common import stage


@pytest.fixture(scope="module")
def stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = [docs]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, sf), name)
        found.append(docs)
    return found


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dups", "secrets", "mix", "pack"]
    assert all(s.schema.names == stages[0].schema.names for s in stages[:-1])


def test_each_stage_takes_effect(stages):
    docs, language, distinct, masked, mixed, packed = ([r.asDict() for r in s.collect()] for s in stages)
    text = {d["doc_id"]: d["text"] for d in docs}
    assert {d["doc_id"] for d in docs} - {d["doc_id"] for d in language} == {
        i for i, t in text.items() if not re.search(r"[^\W\d_]", t or "")
    }
    assert len({d["text"] for d in distinct}) == len(distinct) <= len({d["text"] for d in language})
    for d in masked:
        assert len(d["text"]) == len(text[d["doc_id"]]) and not secret_index.brute_spans(d["text"])
    assert any("█" in d["text"] for d in masked)
    times = Counter(d["doc_id"] for d in mixed)
    assert max(times.values()) <= 3 and set(times) <= {d["doc_id"] for d in masked}
    words = Counter()
    for d in packed:
        words[d["doc_id"]] += d["n_words"]
    assert words == Counter({i: n * len(text[i].split()) for i, n in times.items()})


def test_empty_documents(spark, tmp_path, stages):
    stages[0].limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
