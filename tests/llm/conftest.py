import pytest

CLASH = ("id", "words", "lines", "removed", "text_hash", "fp", "class", "h1", "h2", "first", "kind", "base", "score_", "language", "removed_")
PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree near the quiet river"


@pytest.fixture(scope="session")
def edge_rows():
    """Null id and text, empty, blank, repeated rows, a very long text, unusual characters."""
    return [(None, None), (None, PROSE), (1, ""), (2, " \t\n "), (3, PROSE), (3, PROSE), (4, "Été \U0001f600 " + PROSE), (5, "x"),
            (6, (PROSE + "\n") * 400), (7, "\n\n" + PROSE.upper() + "\n"), (8, "123 456 +++ ###")]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns named like those the operators use inside."""
    df = spark.createDataFrame(edge_rows, "doc_id long, text string")
    for c in CLASH:
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df.cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
