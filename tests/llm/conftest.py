import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from a list of texts or of (doc_id, text) pairs."""

    def make(items, extra=None):
        rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(items)]
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None) for i, t in rows], DOCS)

    return make
