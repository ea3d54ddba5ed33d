"""Tables with the cases that every operator must take: nulls, empty and long texts, ties, repeated rows, odd extra columns."""

import pytest

LONG = " ".join(f"word{k % 977} tail{k % 13}" for k in range(6000))
PASSAGE = " ".join(f"shared passage number {k}" for k in range(30))
ROWS = [
    (1, None, "a", 1), (2, "", "b", 2), (3, "one", None, 3), (4, LONG, "d", 4), (4, LONG, "d", 4),
    (5, "start " + PASSAGE + " end", "e", 5), (6, PASSAGE, "f", 6), (None, "no id here " * 30, "g", 7),
    (7, "grüße ß ñ 漢字 \U0001f600\n\nx\t y", "h", None), (8, "a b c d e f g " * 40, "i", 9), (9, "A B C D e f g " * 40, "i", 9),
    (10, "   \n\t ", "j", 10), (11, "b" * 900, "k", 11),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Column names clash with results of several operators."""
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, score string, block bigint").coalesce(2)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
