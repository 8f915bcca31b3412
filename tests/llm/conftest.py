import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # extra columns with names that the operators use themselves
        T.StructField("fp", T.StringType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("__dropped", T.LongType()),
        T.StructField("__id", T.LongType()),
        T.StructField("token", T.StringType()),
        T.StructField("mix_taken", T.LongType()),
    ]
)


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples, with extra columns of clashing names."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *[None] * (4 - len(row)))
            full.append((doc_id, text, lang, source, None if text is None else len(text), "x", 1, doc_id, doc_id, "t", 5))
        return spark.createDataFrame(full, DOCS)

    return make
