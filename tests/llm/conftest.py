import pytest

from clientcurve.llm._common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, id int, n string, h string, row long, ids string, s string, bucket int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make_docs(spark):
    """(doc_id, text[, source]) rows as documents, with further columns whose
    names clash with those the operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), "x", 1, "y", None, 7, None, "z", 3) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
