import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from texts, or from (doc_id, text) pairs."""

    def make(texts):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make
