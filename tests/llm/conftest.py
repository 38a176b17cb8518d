import pytest


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) rows, with columns whose names clash with the operators' own."""

    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), 7, "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, n int, th string")

    return make
