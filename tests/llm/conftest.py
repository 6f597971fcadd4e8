import pytest

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or longer rows; what is missing is filled in."""

    def build(*rows):
        filled = []
        for row in rows:
            doc_id, text, *rest = row
            lang, source = (rest + ["en", "a"][len(rest) :])[:2]
            filled.append((doc_id, text, lang, source, len(text or "")))
        return spark.createDataFrame(filled, DOCS)

    return build


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
