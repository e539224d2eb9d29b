import random

import pytest

WORDS = [a + b for a in "ka lo mi nu re so ta vi".split() for b in "da fe go hi ju".split()]


@pytest.fixture(scope="session")
def prose():
    """Makes a text of so many words; the same seed gives the same text."""

    def make(n: int, seed: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """NULLs in every column, empty and long texts, repeated rows and ids, and columns with names used inside."""
    base = prose(60, 1)
    rows = [
        (1, base, "en", "a", 1, "x"), (1, base, "en", "a", 1, "x"), (2, base, "en", None, 1, "y"), (3, None, None, "b", None, None),
        (4, "", "en", "b", 0, "z"), (None, prose(40, 2), "en", "a", 2, "x"), (5, prose(30_000, 3), "en", "c", 3, "x"),
        (6, "  \n \n", "en", "c", 4, "x"), (1, prose(20, 4), "en", "a", 1, "x"), (None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row long, key string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
