import pytest
from pyspark.sql import functions as F


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and clashing names."""
    long_text = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long_text, "en", "a", 0, 7), (2, long_text, None, None, 0, None), (2, long_text, None, None, 0, None),
            (3, "", "de", "b", 0, 1), (4, None, "de", "b", None, 1), (None, "no id here", "en", "a", 0, 1),
            (5, " \t\n ", None, "c", 0, 1), (6, "One", "en", "c", 0, 1), (7, "one", "en", "c", 0, 1),
            (8, "1 2 3 été \U0001f600", "fr", None, 0, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int"
    return spark.createDataFrame(rows, schema).withColumn("target", F.lit(1)).withColumn("repeats", F.lit("x"))


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.where("false")
