import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names clash."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r", None, "a", 6), (None, "a null id here", "en", None, 14),
            (4, long, None, None, None), (5, "one", "en", "a", 3), (6, "twice the same row", "en", "a", 18),
            (6, "twice the same row", "en", "a", 18), (7, "four words are few", "de", "b", 18), (8, "é ñ ü 中文 𝕏   x\x00y", "es", "c", 17),
            (9, "x" * 50_000, "en", "a", 50_000), (10, "1 " * 20_000, "en", "a", 40_000)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("score", "kept", "base", "found", "key", "node", "gid", "ids", "length", "n_words", "_t", "distance", "text_"):
        df = df.withColumn(c, F.lit("clash"))
    return df
