import pytest

from verbalis.llm.common import space_of

#: Column names that the operators use inside, as columns of the input.
CLASHES = {"_id": 1, "_row": "r", "_sha": "s", "_at": 2, "count": 3, "key": 4, "words": "w", "cut": 5, "pattern": "p", "n": 6}


@pytest.fixture
def space(spark):
    return space_of(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names clash with names inside the operators."""

    def make(rows, source=False):
        fields = "doc_id long, text string, source string, lang string"
        data = [(i, t, *(rest or ("s",)), "en") for i, t, *rest in rows]
        docs = spark.createDataFrame(data, fields)
        for name, value in CLASHES.items():
            docs = docs.selectExpr("*", f"{value!r} as `{name}`")
        return docs

    return make


LONG = "long words " * 20_000
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one two three four five six seven"),
    (4, "one two three four five six seven"),
    (5, "one  two three\tfour five six seven"),
    (6, "One two three four five six seven"),
    (7, LONG),
    (8, LONG + "."),
    (None, "one two three four five six seven"),
    (None, "no id"),
    (9, "a"),
]


@pytest.fixture(scope="session")
def edges(make_docs):
    return make_docs(EDGES)


@pytest.fixture(scope="session")
def none(edges):
    return edges.limit(0)
