import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents table, as a frame and as rows."""
    frame = spark.read.parquet(f"{SF}/documents.parquet").cache()
    return frame, [tuple(r) for r in frame.select("doc_id", "text").collect()]


LONG = "lorem ipsum dolor sit amet " * 30000

#: Nulls in every column, empty and blank texts, few words, repeated rows, ties, a very long text, clashing names.
ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, bucket string, row string, h int"
ODD = [
    (1, "a b c d e f g h", "en", "s", 15, 9, "x", "y", 1), (2, "A B C D E F G H", "en", "s", 15, 9, None, None, None),
    (3, None, "en", "s", None, None, None, None, None), (4, "", None, "s", 0, None, None, None, None),
    (5, " \n\t ", "de", None, 4, None, None, None, None), (6, "two words", "de", "s", 9, None, None, None, None),
    (7, "two words", "de", "s", 9, None, None, None, None), (7, "two words", "de", "s", 9, None, None, None, None),
    (None, "a b c d e f g h", "en", "s", 15, None, None, None, None), (8, "12 34 !!", None, None, 8, None, None, None, None),
    (9, LONG, "la", "t", len(LONG), None, None, None, None), (10, LONG, "la", "t", len(LONG), None, None, None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
