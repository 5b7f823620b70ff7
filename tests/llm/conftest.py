import pytest
from pyspark.sql import types as T

from strata.llm.shipping import ship

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make_docs(spark):
    """A table of documents from texts or from (doc_id, text, lang, source) rows."""

    def make(items, partitions=2):
        rows = [x if isinstance(x, tuple) else (i, x, "en", "a") for i, x in enumerate(items)]
        return spark.createDataFrame(rows, DOCS).repartition(partitions, "doc_id")

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls in every column, empty and long texts, repeated rows, ties."""
    long = "word " * 30_000
    return make_docs(
        [
            (1, None, "en", "a"),
            (2, "", "en", None),
            (3, " \n\t ", None, "b"),
            (4, long, "en", "b"),
            (None, "no id here at all, not one", None, None),
            (5, "the same row twice in the table", "de", "a"),
            (5, "the same row twice in the table", "de", "a"),
            (6, "x" * 50_000, "fr", "a"),
            (7, "😀 éß 中文 <|endoftext|> it's odd", "fr", "c"),
            (8, "1234 5678 !!", "en", "c"),
        ]
    )


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])
