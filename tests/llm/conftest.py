from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return, as extra columns of their input.
CLASHES = ("score", "fp", "fingerprint", "shard", "slot", "unit", "size", "node", "block", "start", "bit", "key", "held_out",
           "_row", "_id", "_text", "_copies", "_copy", "own")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def docs_of(spark, texts, lang="en", source="s"):
    return frame(spark, [(k, t, lang, source, len(t or "")) for k, t in enumerate(texts)])


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The frames here are small: fewer shuffle partitions, quicker jobs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and blank texts, a very long text, exact
    copies, a repeated row and a repeated id, and clashing extra columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"word{k % 997} and more" for k in range(40_000))
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n", None, None, 3),
        (4, "one", "en", "b", 3),
        (5, "one two three four five", "en", "b", 23),
        (6, "one two three four five", None, "a", 23),
        (6, "one two three four five", None, "a", 23),
        (7, long, "fr", None, len(long)),
        (8, "12345 !!! ???", "de", "b", 13),
        (9, "Été à l'œuvre ünd straße — 日本語 \U0001f600 text", "fr", "c", None),
        (None, "no id here at all", "en", "c", 17),
        (7, "another text of the same id", "en", "c", 27),
    ]
    return frame(spark, rows).withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
