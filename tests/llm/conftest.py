"""Small documents with every awkward case, and what DuckDB needs."""

import pytest
from pyspark.sql import functions as F

PASSAGE = " ".join(f"word{i}" for i in range(70))
LONG = " ".join(f"long{i % 997} text" for i in range(20_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and ids, and extra
    columns with the names that operators use for themselves."""
    rows = [
        (1, "Alpha beta gamma\nsecond line", "en", "a", 27),
        (2, "alpha BETA gamma\nsecond line", "en", "a", 27),
        (2, "alpha BETA gamma\nsecond line", "en", "a", 27),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, " \t\n ", None, "b", 4),
        (None, "Alpha beta gamma\nsecond line", "de", "b", 27),
        (None, None, "de", "b", None),
        (6, LONG, "en", "a", len(LONG)),
        (7, LONG + " tail", "en", "a", len(LONG) + 5),
        (8, f"one start {PASSAGE} and one end", "en", "a", 500),
        (9, f"another start {PASSAGE} and another end", "en", "a", 500),
        (10, "x" * 30_000, "en", "a", 30_000),
        (11, "Ünï çödé ÄÖ 123   end", "de", "b", 20),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ["name", "level", "hash", "kept", "score", "spans", "items", "fp", "words", "block", "key"]
    return df.select("*", *(F.lit("extra").alias(c) for c in clashing))


@pytest.fixture(scope="session")
def no_docs(awkward):
    return awkward.limit(0)
