"""Fixtures of the training-data operators' tests (the session is the suite's)."""

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and a clashing name."""
    rows = [(1, "the cat sat on the mat today again", "en", "a", 7), (2, "the cat sat on the mat today again", "en", "a", 7),
            (2, "the cat sat on the mat today again", "en", "a", 7), (3, None, None, None, None), (4, "", "en", "b", 0),
            (5, LONG, "en", "a", len(LONG)), (6, "ligne une\nligne deux\nligne trois", "fr", None, 3),
            (None, "no id here at all", "en", "b", 1), (8, " \t\n ", "fr", "b", 4), (9, "été à l'école", "fr", "c", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumn("id", F.lit("clash")).withColumn("size", F.lit(-1)).withColumn("u", F.lit("x"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
