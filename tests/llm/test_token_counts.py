from __future__ import annotations

import random

import public_tokenizers
import pytest

from tests.llm.conftest import AWKWARD
from wordbase.llm.token_counts import UNKNOWN, LongestMatch, byte_level_pieces, piece_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def greedy(word, first, more):
    n, at, pieces = 0, 0, first
    while at < len(word):
        best = max((e for e in range(at + 1, min(len(word), at + 140) + 1) if word[at:e] in pieces), default=None)
        if best is None:
            return UNKNOWN
        n, at, pieces = n + 1, best, more
    return n


@pytest.mark.parametrize("seed", range(6))
def test_same_as_greedy(seed):
    rng = random.Random(seed)

    def some(k):
        return {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(k)}

    first, more = some(rng.randint(1, 20)), some(rng.randint(1, 20))
    automaton = LongestMatch(sorted(first), sorted(more))
    for _ in range(3000):
        word = bytes(rng.choices(b"abcd" if rng.random() < 0.1 else b"abc", k=rng.randint(1, 14)))
        assert automaton.count(word) == greedy(word, first, more), word


def test_table(table):
    with open(PATH, encoding="utf-8") as f:
        first, more = map(set, byte_level_pieces(f.read()))
    rows = [(1, "The quick brown fox, don't\tjump 中文 \U0001f600"), (2, "antidisestablishmentarianism " * 50), *AWKWARD]
    for got, (i, text, *_) in zip(piece_counts(table(rows), PATH).collect(), rows, strict=True):
        words = (text or "").encode().split()
        counts = {w: greedy(w, first, more) for w in set(words)}
        assert tuple(got) == (i, len(words), sum(counts[w] for w in words), 0)


def test_unknown_counts_as_one():
    assert LongestMatch([b"a"], [b"b"]).count(b"ac") == UNKNOWN


def test_empty(empty):
    assert piece_counts(empty, PATH).count() == 0
