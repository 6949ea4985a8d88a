import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) as a documents table."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, ties, repeats and one long text."""
    long = " ".join(f"word{k % 977} of{k % 13}" for k in range(6000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (5, "One TWO"), (None, "nobody's text here"),
            (None, None), (6, long), (7, long), (8, "é ß 日本 😀 ñ"), (9, "a\x0bb\x0cc\rd"), (10, "tab\tand  spaces\n\n")]
