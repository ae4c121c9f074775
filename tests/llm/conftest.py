import pytest

LONG = " ".join(f"w{k}" for k in range(30_000))

# Nulls in any column, empty, blank and very long texts, repeated rows and ids.
EDGES = [
    (1, "The cat sat on the mat near the door", "en", "a"),
    (1, "The cat sat on the mat near the door", "en", "a"),
    (2, "the cat sat on the mat near the DOOR", None, "a"),
    (3, None, "en", "b"),
    (4, "", "en", None),
    (5, " \t\n ", None, None),
    (6, LONG, "de", "b"),
    (7, LONG + " more", "de", "b"),
    (8, "one", "en", "a"),
    (8, "two", "en", "a"),
    (None, "no id at all here", "en", "b"),
    (None, None, None, None),
    (9, "émile été ñandú 日本 🙂", "fr", "c"),
]

# Names that the operators use themselves.
CLASHING = (
    "id row doc score spans good threshold rejected copies size taken node bucket part high low signature n_words items"
).split()


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, clashing=False):
        table = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string")
        if clashing:
            table = table.selectExpr("*", *[f"'x' AS {name}" for name in CLASHING])
        return table

    return make


@pytest.fixture(scope="session")
def edges(docs_of):
    return docs_of(EDGES)


@pytest.fixture(scope="session")
def clashing(docs_of):
    return docs_of(EDGES, clashing=True)


@pytest.fixture(scope="session")
def nothing(docs_of):
    return docs_of([])
