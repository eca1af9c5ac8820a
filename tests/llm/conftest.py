import random
import sys

import pytest

DDL = "doc_id long, text string, lang string, source string, rid long, name string, n int, size int, row string"


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text, lang, source)`` with extra columns whose names operators use."""
    def make(*rows):
        return spark.createDataFrame([(*r, 7, "x", 1, 2, "y") for r in rows], DDL)
    return make


def prose(seed: int, words: int, letters="abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(words))


@pytest.fixture
def odd_rows():
    """Null columns, empty and very long texts, ties and repeated rows."""
    long = prose(5, 60_000)
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "one two", None, "b"), (4, "one two", "en", None),
        (None, "one two", "en", "b"), (5, long, "en", "b"), (6, long, "en", "c"), (7, " \n\t ", "en", "c"),
        (8, "x" * 200_000, "en", "c"), (9, prose(9, 300), "en", "c"), (9, prose(9, 300), "en", "c"),
        (10, "...!!! 123", "en", "d"), (11, "é" * 5000 + " 漢字 😀", "fr", "d"),
    ]


sys.modules.setdefault("llm_prose", sys.modules[__name__])
