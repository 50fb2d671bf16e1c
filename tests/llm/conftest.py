import pytest
from pyspark.sql import types as T

#: Columns whose names the operators use inside, to be carried or ignored.
CLASHING = [
    "_key", "size", "row", "node", "length", "_row", "label", "bucket", "_own", "_nth", "_node", "_d", "_k", "_n",
    "_sha", "_copy", "_source", "_size", "_hash", "_id", "_cell", "_parts", "comp", "recipe", "further", "odd name",
]


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table like documents, with further columns, from (doc_id, text, lang, source)."""

    def make(rows):
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("source", T.StringType()),
                *(T.StructField(c, T.StringType()) for c in CLASHING),
            ]
        )
        full = [(*r, *[None] * (4 - len(r)), *CLASHING) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null in every column, empty, blank, very long and repeated texts, repeated ids."""
    long_text = "word another thing here now " * 20000
    return [
        (None, None, None, None),
        (None, "a text without an id here", "en", None),
        (1, None, "en", "s"),
        (2, "", None, "s"),
        (3, " \n\t ", "en", "s"),
        (4, "one", "en", None),
        (5, "one", "en", "s"),
        (5, "one", "en", "s"),
        (6, "Die Katze ist heute müde und schläft", "de", "t"),
        (7, "the cat is tired today and sleeps", "en", "t"),
        (8, long_text, "en", "t"),
        (9, "x" * 100_000, "en", "t"),
        (10, "12 345 !!", "en", "t"),
        (11, "<|endoftext|> and more　 text", "en", "s"),
    ]
