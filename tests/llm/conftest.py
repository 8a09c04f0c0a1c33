import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

#: Names the operators use inside, or return.
CLASHING = ["_id", "_row", "_text", "_doc", "_bucket", "size", "kept", "length", "score", "base"]

# A text far longer than most.
LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(12_000))
PROSE = "the quick brown fox jumps over the lazy dog near the old river bank every day"
ODD_ROWS = [
    (None, None, None),
    (None, "", "b"),
    (1, None, "a"),
    (1, "", None),
    (2, " \t\n", "a"),
    (3, PROSE, "a"),
    (4, PROSE, "a"),
    (4, PROSE, "a"),  # a repeated row
    (5, PROSE.upper(), None),
    (6, PROSE.replace("river", "ÉCOLE"), "b"),
    (7, LONG, "b"),
    (7, LONG + " tail", "b"),  # another text with the same id
    (-8, "ß<|endoftext|> Σας ﬁ é   \U0001f600\nİzmir don't AKIA", "\U0001f600"),
    (9, "x", "￿"),
    ((1 << 62) + 1, "a b c d", "b"),
    (10, PROSE + "\n" + PROSE + "\n\n" + PROSE.replace("fox", "cat"), "a"),
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def with_others(frame):
    """The columns of documents, and some whose names the operators use too."""
    return frame.withColumns(
        {"lang": F.lit("en"), "n_chars": F.length("text").cast("long")}
        | {name: F.lit(f"own {name}") for name in CLASHING}
    )


@pytest.fixture(scope="session")
def odd(spark):
    return with_others(spark.createDataFrame(ODD_ROWS, SCHEMA))


@pytest.fixture(scope="session")
def nothing(spark):
    return with_others(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(row.doc_id, row.text or "") for row in documents.orderBy("doc_id").collect()]
