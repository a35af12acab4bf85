from __future__ import annotations

import base64
import math
import random
import time
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD
from wordbase.llm import lattice

PATH = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(word):
    for k in range(len(word)):
        for cuts in combinations(range(1, len(word)), k):
            at = [0, *cuts, len(word)]
            yield [word[a:b] for a, b in zip(at, at[1:], strict=False)]


def small(seed):
    rng = random.Random(seed)
    pieces = sorted({bytes(rng.choices(b" ab", k=1) + rng.choices(b"ab", k=rng.randint(0, 3))) for _ in range(12)} | {b" ", b"a", b"b"})
    p = np.array([rng.random() for _ in range(len(pieces) + 1)])
    return pieces, np.log(p / p.sum())


@pytest.mark.parametrize("seed", range(4))
def test_forward_and_expected_counts(seed):
    pieces, scores = small(seed)
    chance = dict(zip(pieces, np.exp(scores).tolist(), strict=False))
    words = [bytes(random.Random(i).choices(b"ab", k=1 + i % 7)) for i in range(20)]
    tree = lattice.Pieces(pieces)
    counts = np.arange(1.0, 21)
    got, expected = np.empty(20), np.zeros(len(scores))
    for at, matrix in lattice.by_length(words):
        got[at] = tree.forward(matrix, scores)
        expected += tree.expected(matrix, counts[at], scores)
    want = np.zeros(len(scores))
    for i, word in enumerate(words):
        ways = [(math.prod(chance.get(p, 0) for p in way), way) for way in segmentations(b" " + word)]
        total = sum(p for p, _ in ways)
        assert math.isclose(got[i], math.log(total), abs_tol=1e-9)
        for p, way in ways:
            for piece in way if p else ():
                want[pieces.index(piece)] += counts[i] * p / total
    assert np.allclose(expected, want)


@pytest.mark.parametrize("stretch", [1, 3, 50])
def test_long_words_as_short_ones(stretch, monkeypatch):
    """Stretch by stretch the sums are those of whole words, also where plain numbers would be too small."""
    pieces, scores = small(9)
    tree = lattice.Pieces(pieces)
    rng = random.Random(stretch)
    words = [bytes(rng.choices(b"ab", k=k)) for k in (1, 2, 5, 17, 60)] + [b"ab" * 1500]
    counts = np.arange(1.0, 7)
    results = []
    for long_word in (10_000, 0):
        monkeypatch.setattr(lattice, "LONG_WORD", long_word)
        monkeypatch.setattr(lattice, "STRETCH", stretch)
        got, expected = np.empty(len(words)), np.zeros(len(scores))
        for at, matrix in lattice.by_length(words):
            got[at] = tree.forward(matrix, scores)
            expected += tree.expected(matrix, counts[at], scores)
        results.append((got, expected))
    assert np.allclose(results[0][0], results[1][0], rtol=1e-12) and np.allclose(results[0][1], results[1][1], rtol=1e-9)
    assert results[0][0].min() < -800  # beyond the smallest number


def test_an_unbroken_blob():
    """A megabyte without a space takes seconds."""
    blob = base64.b64encode(random.Random(3).randbytes(750_000)).lower()
    pieces, start = lattice.read_vocabulary(PATH)
    tree = lattice.Pieces(pieces)
    ((_, matrix),) = lattice.by_length([blob])
    begun = time.process_time()
    expected = tree.expected(matrix, np.array([2.0]), start)
    assert time.process_time() - begun < 30  # 3.5 on an idle machine
    letters = sum(n * len(p) for n, p in zip(expected, pieces, strict=False))
    assert math.isclose(letters, 2 * (len(blob) + 1), rel_tol=1e-6)  # every byte is in one piece


def test_probabilities_of_all_words_are_a_distribution():
    """The chance of ending after any number of pieces sums to one, so texts have a total of one at most."""
    pieces, start = lattice.read_vocabulary(PATH)
    assert math.isclose(np.exp(start).sum(), 1) and len(start) == len(pieces) + 1
    assert {bytes([b]) for b in range(256)} <= set(pieces)
    assert not any(b" " in p[1:] for p in pieces)


def test_table(spark, table):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["the", "Cat", "naïve", "zyx", "中"], k=rng.randint(0, 12)))) for i in range(60)] + AWKWARD
    docs = table(rows)
    held = F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False))
    got = lattice.document_scores(docs, held, PATH).collect()

    def tokens(t):
        return [*(t or "").encode().lower().split(), b""]

    training = Counter(w for i, t in rows if i is None or i % 4 != 1 for w in tokens(t))
    n, v = sum(training.values()), len(training)
    pieces, start = lattice.read_vocabulary(PATH)
    tree = lattice.trie(tuple(pieces))
    scores = start
    words = [w for w in training if w]
    for _ in range(lattice.ROUNDS):
        counts = lattice.PRIOR * len(pieces) * np.exp(start)
        for at, matrix in lattice.by_length(words):
            counts += tree.expected(matrix, np.array([training[words[k]] for k in at], float), scores)
        counts[-1] = training[b""] + lattice.PRIOR
        scores = np.log(counts / counts.sum())

    def word_score(w):
        return (tree.forward(np.frombuffer(b" " + w, np.uint8)[None], scores)[0] if w else scores[-1]) / math.log(10)

    known = {w: word_score(w) for _, t in rows for w in tokens(t)}
    want = []
    for i, t in rows:
        own = tokens(t)
        base = sum(math.log10((training[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        want.append((i, i is not None and i % 4 == 1, len(own), sum(training[w] > 0 for w in own), n, base, sum(known[w] for w in own)))
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=lambda r: (str(r[0]), r[2], r[5])), sorted(want, key=lambda r: (str(r[0]), r[2], r[5])), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9)


def test_learning_helps(spark):
    """Held-out text is likelier after learning, and likelier than the same letters shuffled."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars > 200")
    held = F.col("doc_id") % 4 == 1

    def mean(rows, rounds):
        out = lattice.document_scores(rows, held, PATH, rounds).where("held_out")
        return out.agg(F.sum("score") / F.sum("n_tokens")).first()[0]

    mixed = docs.withColumn("text", F.when(held, F.reverse("text")).otherwise(F.col("text")))
    assert mean(docs, 0) < mean(docs, 2) and mean(mixed, 2) < mean(docs, 2)


def test_empty(empty, table):
    assert lattice.document_scores(empty, F.lit(False), PATH).count() == 0
    alone = lattice.document_scores(table([(1, "a b")]), F.lit(True), PATH).first()
    assert (alone["n_known"], alone["train_tokens"], alone["n_tokens"]) == (0, 0, 3)
