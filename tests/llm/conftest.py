import random

import pytest

#: Names the operators use inside; a table may have columns called so.
CLASHING = (
    "row size key digest of u copies target cut whole fp gone anchor component_id keep_id found "
    "batch bucket score text_key tag level weight rank host n row_ text_ Row"
).split()[:-1]

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "the", "of", "nous", "und", "señor", "x", "2024-02-29", "日本語"]
    long = " ".join(rng.choice(vocabulary) for _ in range(60_000))
    rows = [
        (1, "one two three four five six", "en", "a", 1),
        (2, "one two three four five six", "en", "b", None),
        (2, "one two three four five six", "en", "b", None),
        (3, None, "en", "a", 0),
        (4, "", None, None, 0),
        (5, "", "fr", None, 0),
        (6, long, "en", "a", len(long)),
        (7, long + " end", None, "c", None),
        (8, " \t\n\x0b\x0c\r ", "de", "c", 7),
        (9, "!!! ??? 123", "de", "", 11),
        (None, "no id here at all", None, None, None),
        (None, None, None, None, None),
        (10, "a\u0085b c word", "en", "b", 4),
        (11, "ONE two three four FIVE six", "en", "é", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    docs = spark.createDataFrame(edge_rows(), DOC)
    for i, name in enumerate(CLASHING):
        from pyspark.sql import functions as F

        docs = docs.withColumn(name, F.lit(i))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def some_docs(spark):
    """The smallest test table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
