import pytest

from obs_analytics.llm.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


LONG = " ".join(f"word{i % 997}" for i in range(20_000)) + "."

#: (doc_id, text): null, empty, blank, short, very long, ties, exact repeats, a row without an id.
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, LONG), (6, "same text as seven"), (7, "same text as seven"),
         (8, "a repeated row"), (8, "a repeated row"), (None, "no id here"), (9, "ünïcödé — ÀÉ 😀  x y")]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows with extra columns whose names clash with inner ones."""
    names = ["place", "text_key", "node", "n", "n_words", "score", "hits", "ids", "others", "kept", "label", "bucket"]
    extra = ", ".join(f"{i} AS {name}" for i, name in enumerate(names))
    return spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("doc_id", "text", extra.split(",")[0], *[e.strip() for e in extra.split(",")[1:]])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")
