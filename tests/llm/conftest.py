import pytest
from pyspark.sql import types as T

# Columns with names that the operators use inside, to show that they do not clash.
EXTRA = ("text_key", "batch", "__id", "__key", "copies", "size", "part", "n")


@pytest.fixture(scope="session")
def table(spark):
    """A function of (doc_id, text[, source[, lang]]) tuples to a documents frame with further, clashing columns."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("text", "lang", "source", *EXTRA))]
    )

    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else None, r[2] if len(r) > 2 else None, *("x" for _ in EXTRA)) for r in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Rows every operator must survive: NULLs, empty and blank texts, repeats, one long text, a shared id."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return [
        (1, None, "a", "en"), (2, "", None, None), (3, " \t\n", "a", "en"), (4, "one", "b", "fr"), (5, "one", "b", "fr"), (6, long, "a", "en"),
        (6, long, "a", "en"), (7, "two words", None, "en"), (7, "other words here", "c", "en"), (None, "one", "c", None), (None, None, None, None),
        (8, "Ünïcödé   non break", "d", "de"), (9, long + " end", "a", "en"), (10, "!!! 123", "a", "en"),
    ]
