"""Fixtures of these tests; a second conftest would hide the first one's names."""

import pytest
from pyspark.sql import functions as F

from snapline.llm.common import importable


@pytest.fixture(autouse=True)
def workers_can_import(spark):
    importable(spark)


SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 977} the of and" for i in range(8_000))
    rows = [
        (1, "The cat sat on the mat and looked at the moon for a long while", "en", "a", 1),
        (1, "The cat sat on the mat and looked at the moon for a long while", "en", "a", 1),
        (2, "the CAT sat on the mat and looked at the moon for a long while", "en", "b", None),
        (3, None, None, None, None),
        (None, "no id here, but words and a token = 'abcdef123456'", "en", "a", 3),
        (None, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \t\n", "en", "b", 3),
        (7, long, "en", "c", 5),
        (8, "1234 5678 !!!", None, "c", 5),
        (9, "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf der die das und", "de", None, 5),
        (10, "one", "en", "b", 5),
        (11, "one", "en", "b", 5),
    ]
    df = spark.createDataFrame(rows, DOCS)
    clash = ["size", "draw", "target", "reps", "cls", "component", "words", "hits", "items", "doc", "score", "_row", "label", "shard", "_text", "step", "rows"]
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])
