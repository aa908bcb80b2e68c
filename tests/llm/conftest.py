import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of every awkward kind, with columns whose names clash with results."""
    long = " ".join(f"word{i % 900} the of" for i in range(9000))
    base = "the quick brown fox of the north jumps over a lazy dog and runs to the river in the dark of night"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, None, "en", None),
        (4, "", None, None),
        (5, " \t\n\x0b\f\r ", "en", "b"),
        (6, long, "en", "b"),
        (7, base.upper() + " !!", "en", "é"),
        (None, "a row without an id in the table of the documents is still a row of it", "en", "c"),
        (9, "password = 'abcdefghijklmnop' and AKIA" + "Z" * 16 + " then 0123456789abcdef0 é token:short", "en", "c"),
        (10, "one two three four five " * 8, "en", "c"),
        (11, "x y", "en", "c"),
        (12, "### $$$ the of %%% &&& and to in is it", "en", "b"),
    ]
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for clash in ("n_words", "kept", "spans", "fp", "component_id", "taken", "target", "copies", "verdict"):
        out = out.withColumn(clash, F.lit("mine"))
    return out


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
