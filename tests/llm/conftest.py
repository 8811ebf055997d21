import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("extra", T.ArrayType(T.StringType())),
                     # names that the operators use inside
                     T.StructField("digest", T.StringType()), T.StructField("node", T.StringType()), T.StructField("key", T.DoubleType()),
                     T.StructField("score", T.StringType()), T.StructField("label", T.StringType())])

LONG = " ".join(f"w{i % 977}x{i % 131}" for i in range(60_000))
EDGE = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\x0b", None, None, 4), (4, "Word", "en", "", 4), (5, LONG, "de", "a", len(LONG)),
    (6, "same text in two rows with one id here", "en", "b", 1), (6, "same text in two rows with one id here", "en", "b", 1),
    (7, "same text in two rows with one id here", None, "b", 1), (None, "a row without an id but with words", "en", "b", 1), (8, "ünï códe — wörds ¿qué?", "es", None, 1),
    (9, "x" * 50_000, "en", "c", 50_000), (10, "one two three four", "en", "c", 1), (11, "\x00nul\x00 bytes \x7f here", "en", "c", 1),
]


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        return spark.createDataFrame([(*r, ["e"], "d", "n", 0.5, "s", "l") for r in rows], DOCS)
    return build


@pytest.fixture(scope="session")
def edge(make):
    return make(EDGE)


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def labels(spark):
    """Labels with nulls, repeats and ids that no document has."""
    rows = [(4, 1, 0), (5, 1, 0), (7, 0, 0), (7, 0, 1), (10, 1, 1), (None, 1, 0), (11, None, None), (999, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
