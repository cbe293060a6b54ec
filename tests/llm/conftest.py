import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("digest", T.StringType()), T.StructField("id", T.StringType()),
                       T.StructField("score", T.DoubleType())])


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) with extra columns whose names clash."""
    def make(*rows):
        return spark.createDataFrame([(*r, *[None] * (4 - len(r)), "x", "y", 0.5) for r in rows], SCHEMA)
    return make


@pytest.fixture
def labels(spark):
    def make(column, *rows):
        return spark.createDataFrame(list(rows), f"doc_id long, {column} int")
    return make


#: Null and empty texts, a tie of copies, a repeated row, a null id, and null other columns.
ODD = [(1, None), (2, ""), (3, "a  b\tc", "en", "h"), (4, "a b c", None, "h"), (4, "a b c", None, "h"),
       (None, "a b c", "en", None), (7, "long " * 40_000, "en", "h"), (8, "ü 日本 \n\n|x| <|endoftext|>", "de", "g")]
