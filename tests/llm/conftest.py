import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a ``documents`` table of rows (doc_id, text, source)."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS
        )

    return make
