import pytest
from pyspark.sql import types as T

#: Nulls, empty and blank texts, ties, repeated rows, repeated ids, a long text, clashing column names.
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
ROWS = [
    (1, PROSE, "en", "a"), (2, "x " + PROSE + " y", "en", "b"), (2, "x " + PROSE + " y", "en", "b"),
    (3, None, None, None), (4, "", "en", "a"), (5, " \n\t ", None, "a"), (None, PROSE, "en", None), (None, None, None, None),
    (6, "äöü ß Ünïcode   text. 漢字 \x0b\x0c end", "de", "a"), (6, "another text under the same id", "de", "a"),
    (7, ("lorem ipsum dolor sit amet " * 3000).strip(), "fr", "a"), (8, "12345 !!! ???", "fr", "c"), (9, PROSE.upper(), "en", "c"),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # names the operators use themselves
                       T.StructField("version", T.StringType()), T.StructField("row", T.StringType()), T.StructField("key", T.StringType()),
                       T.StructField("words", T.StringType()), T.StructField("_id", T.StringType()), T.StructField("kept", T.StringType())])


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case."""
    return spark.createDataFrame([(i, t, l, s, len(t or ""), "v", "r", "k", "w", "i", "k") for i, t, l, s in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
