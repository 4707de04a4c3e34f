"""Tables and fixtures of the document operator tests."""

import os
import sys

import pytest

TESTS = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (TESTS, os.path.dirname(TESTS)):
    if folder not in sys.path:
        sys.path.insert(0, folder)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text, lang) of the small table."""
    import duckdb

    return duckdb.sql(f"select doc_id, text, lang from '{SMALL}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def toxic_labels():
    import duckdb

    return duckdb.sql(f"select doc_id, toxic from '{SMALL}/labels.parquet'").fetchall()


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, keep_id long, _llm_id long, comp long"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows, clashing columns."""
    long_text = "lorem ipsum dolor " * 40_000
    rows = [
        (1, "the same words in the same order stand here", "en", "a", 1),
        (2, "the same words in the same order stand here", "en", "a", 1),
        (2, "the same words in the same order stand here", "en", "a", 1),
        (3, None, None, None, None),
        (None, None, None, None, None),
        (None, "the same words in the same order stand here", None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n", "en", "b", 3),
        (6, long_text, "en", "b", len(long_text)),
        (7, "x" * 100_000, None, "b", 100_000),
        (8, "einzeln", "de", "c", 7),
        (9, "12345 67890 !!!", "de", "c", 15),
        (10, "the  same words in the same order stand\nhere", "en", "a", 1),
    ]
    return spark.createDataFrame([(*r, 0.5, -1, -2, -3) for r in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
