import pytest

LONG = " ".join(f"word{i % 977} thing{i}" for i in range(30_000))
BASE = " ".join(f"plain{i}" for i in range(60))

#: (doc_id, text, source): nulls in every column, empty and very long texts, repeated rows, ties.
DOCS = [
    (1, BASE, "a"),
    (2, BASE, "a"),
    (2, BASE, "a"),
    (3, None, "a"),
    (4, "", None),
    (5, " \n\t ", "b"),
    (None, BASE, "b"),
    (None, None, None),
    (6, LONG, "a"),
    (7, "one two", "a"),
    (8, BASE + " tail", "b"),
    (9, "Ünï 日本 \U0001f642 it's  two  spaces\n\nlines ", "b"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """The odd rows above, with extra columns that clash with output names."""
    rows = [(i, t, "en", s, len(t) if t else None, 7.0, "x", True) for i, t, s in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, host string, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
