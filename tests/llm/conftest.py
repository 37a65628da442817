import pytest

SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977} alpha beta{i % 31}" for i in range(40_000))

#: Nulls in every column, empty and very long texts, ties, repeated rows.
ROWS = [
    (1, "plain words that say little but say it twice and then say it again here", "en", "a", 70),
    (2, None, None, None, None), (None, "a text whose document has no id at all but words enough to judge it", "de", "b", 4),
    (None, None, None, None, None), (3, "", "fr", "a", 0), (4, " \t\n ", "es", "a", 4), (5, LONG, "en", "b", len(LONG)),
    (6, "plain words that say little but say it twice and then say it again here", "en", "a", 70),
    (6, "plain words that say little but say it twice and then say it again here", "en", "a", 70),
    (7, "é 日本語 😀 mixed scripts here and \x1c controls", "de", "c", 9), (7, "same id, other text", "en", "c", 19),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def no_docs(odd):
    return odd.limit(0)


@pytest.fixture
def small():
    return SMALL
