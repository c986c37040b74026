import pytest

from webloom.llm import common

EDGE_TEXTS = [None, "", " ", "one", "A\tb\nc", "x " * 30_000, "é😀 ß", "same text here now", "same text here now"]


@pytest.fixture(scope="session")
def llm_spark(spark):
    common.ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


@pytest.fixture
def docs_of(llm_spark):
    """Documents of (doc_id, text) rows, with extra columns whose names operators also use."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), 1.5, "x", 7) for i, t in rows]
        return llm_spark.createDataFrame(
            full,
            "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, "
            "spans string, fp int",
        )

    return make


@pytest.fixture
def edge_docs(docs_of):
    """Nulls, empty and long texts, ties and repeated rows."""
    return docs_of([(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, "no id"), (7, EDGE_TEXTS[7])])


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])
