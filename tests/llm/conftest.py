import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, text_ string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame of (doc_id, text) pairs with a clashing extra column."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "extra") for i, t in rows], DOCS)

    return make
