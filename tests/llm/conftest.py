"""Tables with the rows that every operator must bear."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, row int, check string, h double, block array<int>"


@pytest.fixture(scope="session")
def table(spark):
    """A function that makes a table of documents from (id, text) or (id, text, lang), with columns whose names clash."""

    def make(rows):
        full = [(i, t, *(more or (None,)), None, None, 7, 1, "c", 0.5, [1]) for i, t, *more in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t"), (4, "!!! ... \u2028 ???"), (5, "word"), (5, "word"), (6, "word"), (None, "word"), (None, None),
    (7, "a\x01b\x1ec \u00e9\u4e2d\U0001f600 <|endoftext|>"), (8, "x" * 70_000), (9, "the cat sat " * 9_000), (10, "9" * 60_000), (11, "a@" * 3_000),
]


@pytest.fixture(scope="session")
def awkward(table):
    return table(AWKWARD)


@pytest.fixture(scope="session")
def empty(table):
    return table([])
