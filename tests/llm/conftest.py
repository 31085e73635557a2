import pytest

from tests.conftest import SMALL, spark  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):  # noqa: F811
    """Nulls in every column, empty and very long texts, repeated rows."""
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", None, 0), (None, "no id at all here", "en", "a", 17),
        (3, "word " * 30_000, None, "b", None), (4, "the same text twice over", "en", "b", 1), (4, "the same text twice over", "en", "b", 1),
        (5, "the same text twice over", "en", "c", 1), (6, "x" * 50_000, "en", "c", 1), (7, " \n\n \t", "en", None, 4),
        (4, "another text under the same id", "en", "b", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):  # noqa: F811
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):  # noqa: F811
    return spark.read.parquet(f"{SMALL}/documents.parquet")
