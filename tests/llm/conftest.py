"""Inputs that every corpus operator has to take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, Ids string, spans int, " \
         "of string, its_id int, its_hash string, cuts string, hits int, hit string, found string, at int, page string, removed int"
OWN = ("o", 1, "h", "c", 2, "i", "f", 3, "p", 4)  # the columns that no operator makes
LONG = " ".join(f"word{i % 977} piece{i % 31}" for i in range(30_000))
PASSAGE = "one more line\nand a second one\nthe third of them\n"

ROWS = [
    (1, "The plain text of a document with a few words in it.", "en", "a", 52, "x", "y", 1),
    (1, "The plain text of a document with a few words in it.", "en", "a", 52, "x", "y", 1),
    (2, None, "en", None, None, None, None, None),
    (3, "", None, "b", 0, "x", "y", 1),
    (4, " \n\n\t ", "de", "b", 5, "x", "y", 1),
    (5, LONG, "en", "a", len(LONG), "x", "y", 1),
    (None, "A text without any id, but with words.", "en", "a", 38, "x", "y", 1),
    (7, "Ü", None, None, 1, None, None, None),
    (8, "\U0001F600 你好 \u0000 � 12", "en", "a", 12, "x", "y", 1),
    (9, PASSAGE + "own ending", "en", "a", 60, "x", "y", 1),
    (10, "own start\n" + PASSAGE, "en", "a", 60, "x", "y", 1),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(*r, *OWN) for r in ROWS], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
