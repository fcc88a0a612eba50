import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents frame from (doc_id, text) pairs, or from (doc_id, text, more) with extra columns."""

    def made(pairs, extra=""):
        rows = [(p[0], p[1], "en", "s", None if p[1] is None else len(p[1]), *p[2:]) for p in pairs]
        return spark.createDataFrame(rows, DOCUMENTS + (f", {extra}" if extra else ""))

    return made


@pytest.fixture(scope="session")
def prose():
    """Invented words, the same for the same seed."""

    def made(seed, words):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(words))

    return made


@pytest.fixture(scope="session")
def awkward(prose):
    """Nulls, empty and very long texts, ties, repeated rows and signs."""
    long_ = prose(1, 30_000)
    return [
        (1, prose(2, 80)), (2, None), (3, ""), (None, prose(3, 50)), (None, None), (4, "   \n\t "), (5, long_),
        (6, "one"), (6, "one"), (7, prose(2, 80)), (7, prose(4, 60)), (8, "é ü 漢字   x" * 30), (9, "\u0000 a"), (10, "a" * 3000),
    ]
