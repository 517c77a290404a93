import pytest
from pyspark.sql import types as T

from tallyloom.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `curve` string, `score` string, `ids` string"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns named like results."""
    long_text = " ".join(f"wort{i % 977} ende{i % 13}." for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", "y", "z"),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", "y", "z"),
        (2, "the quick brown fox jumps over the lazy dog", None, None, None, None, None, None),
        (3, None, "de", "a", None, "x", "y", "z"),
        (4, "", "de", "a", 0, "x", "y", "z"),
        (5, "  \n\t ", "de", None, 5, "x", "y", "z"),
        (None, "zwei Wörter", "de", "b", 11, "x", "y", "z"),
        (None, None, None, None, None, None, None, None),
        (6, long_text, "de", "b", len(long_text), "x", "y", "z"),
        (7, "a\x0bb\x0cc\x1cd e\xa0f é 😀 ▁x", "fr", "b", 9, "x", "y", "z"),
        (8, "x" * 50_000, "fr", "b", 50_000, "x", "y", "z"),
    ]
    return llm.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(llm):
    return llm.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(1, 9)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


assert T
