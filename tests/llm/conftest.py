import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

LONG = "word " * 30_000 + "x" * 60_000
#: nulls, empty and blank texts, very long ones, ties and rows that repeat
ODD = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, LONG), (5, "Éa ça, 漢字 😀"), (6, "one"), (3, "one"), (None, "no id"), (None, None)]


@pytest.fixture
def docs(spark):
    """Documents from (id, text) or (id, text, source); an empty list gives an empty table."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def odd(docs):
    return docs(ODD)
