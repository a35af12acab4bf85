from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import AWKWARD
from wordbase.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, out, max_len=2048):
    """Every id in exactly one piece, sequences without gaps; returns the share of padding."""
    tokenizer = Tokenizer.from_file(PATH)
    wanted = defaultdict(int)
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), max_len):
            part = ids[s : s + max_len]
            wanted[i, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in out:
        got[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == wanted
    total = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= max_len
        total += at
    return 1 - total / (max_len * len(sequences)) if sequences else 0


def test_same_ids_and_places(table):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["the", "Cat's", "naïve", "12,5", "\n\n", "  ", "中文", "😀", "they'll"], k=rng.choice([1, 5, 300, 3000])))) for i in range(150)]
    rows += [(900, "same text here")] * 40 + AWKWARD
    out = packing.pack_documents(table(rows), PATH).collect()
    check(rows, out)


def test_long_runs(table):
    """Over a million blanks or line breaks in a row, which the fast encoder refuses; and as many of anything else."""
    n = 1_100_000
    rows = [(1, "a" + " " * n + "b"), (2, "\n" * n), (3, "\t \u00a0" * (n // 3) + "c <|endoftext|>"), (4, "!" * n), (5, "ab" * (n // 2)), (6, "7" * n)]
    rows += [(7, "x" + " " * (packing.LONG_RUN - 1) + "y"), (8, "x" + " " * packing.LONG_RUN + "y"), (9, "\x1c" * packing.LONG_RUN)]
    check(rows, packing.pack_documents(table(rows), PATH).collect())


def test_little_padding(table):
    rng = random.Random(2)
    rows = [(i, "the " * min(9000, int(rng.lognormvariate(6, 1)))) for i in range(2000)]
    assert check(rows, packing.pack_documents(table(rows), PATH).collect()) < 0.01


def test_patterns_hold_the_histogram():
    rng = random.Random(3)
    for _ in range(60):
        size = rng.choice([10, 64, 100])
        histogram = {rng.randint(1, size): rng.randint(1, 50) for _ in range(rng.randint(1, 30))}
        patterns = packing.shortest_pack_first(histogram, size)
        held = defaultdict(int)
        for count, content in patterns:
            assert sum(length * n for length, n in content) <= size
            for length, n in content:
                held[length] += count * n
        assert held == histogram
        assert len(patterns) <= 3 * len(histogram) + 2


def test_empty(empty):
    assert packing.pack_documents(empty, PATH).count() == 0
