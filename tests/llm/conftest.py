import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ids out of order."""
    long = "a word and another one here. " * 8000
    rows = [
        (5, None, "en", "a", 0),
        (3, "", None, "b", 0),
        (None, "text without an id, of ten words and then some more", "en", None, None),
        (9, long, "en", "a", len(long)),
        (9, long, "en", "a", len(long)),
        (7, " \t\n ", "x-y", "b", 4),
        (1, "é中\U0001f600 𝒳 ", "DE", "b", 6),
        (2, "one", "fr", "c", 3),
        (2, "one", "fr", "c", 3),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
