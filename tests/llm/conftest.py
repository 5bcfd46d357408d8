import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
CLASH = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("lang", "source", "part", "seq", "grp", "tie", "length", "media", "words", "key", "token", "n", "uid", "word", "pos", "score")]
    + [T.StructField("n_chars", T.LongType())]
)


def make(spark, rows):
    """Documents of (doc_id, text), with more columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, *["x"] * (len(CLASH) - 3), 7) for d, t in rows], CLASH)


@pytest.fixture(scope="session")
def odd_rows():
    long = " ".join(f"word{i % 977}x" for i in range(30_000))
    same = "The same text, twice in the table. " * 4
    return [(1, None), (2, ""), (3, " \n\t "), (4, "short"), (5, same), (6, same), (5, same), (None, "no id at all"), (None, None), (7, long), (8, "Tab\there\x0bnew\x0cpage\r\nline ß É <|endoftext|> don't 12,5 日本 🙂")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return make(spark, odd_rows)


@pytest.fixture(scope="session")
def empty(spark):
    return make(spark, [])


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
