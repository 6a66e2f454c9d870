import pytest


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """Nulls in every column, empty and very long texts, repeated rows, equal keys with other texts."""
    long_text = " ".join(f"word{i % 977} other{i % 13}" for i in range(30_000)) + "\n" + "x" * 50_000
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 59),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 59),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "b", 59),
        (2, "another text under the same key", "en", "b", 31),
        (3, None, "en", "a", None), (4, "", None, "b", 0), (5, " \n\t ", "en", None, 4),
        (None, "no key here but words", None, None, None), (None, None, None, None, None),
        (6, long_text, "en", "c", len(long_text)), (7, "1234 5678 !!", "de", "a", 12), (8, "écrit là-bas \U0001F600 漢字", "fr", "c", 17),
    ]
    return spark.createDataFrame(rows, docs_schema)


@pytest.fixture(scope="session")
def no_docs(spark, docs_schema):
    return spark.createDataFrame([], docs_schema)
