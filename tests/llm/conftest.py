import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those the operators use."""

    def make(*pairs, source="src1"):
        rows = [(i, t, "en", source, len(t or ""), 1, "x") for i, t in pairs]
        return spark.createDataFrame(rows, DOC_SCHEMA + ", copy int, _hash string")

    return make


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture
def tuples():
    return rows
