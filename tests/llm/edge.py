import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Null in every column, empty, blank and very long texts, ties, repeated rows.
EDGE_DOCS = [
    (1, "the quick brown fox", "en", "a", 19),
    (1, "the quick brown fox", "en", "a", 19),
    (2, None, None, None, None),
    (3, "", "en", "", 0),
    (4, " \t\n ", "de", "b", 4),
    (5, "wort " * 40_000, "de", "b", 200_000),
    (6, "x" * 100_000, None, "a", 100_000),
    (7, "the quick brown fox", "en", "b", 19),
    (None, "no id, é ß 漢字 \U0001f600", "fr", "a", 14),
    (-8, "1234 !!! ▁▁ <|endoftext|>", "es", None, 5),
]


@pytest.fixture
def edge_docs(spark):
    return spark.createDataFrame(EDGE_DOCS, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
