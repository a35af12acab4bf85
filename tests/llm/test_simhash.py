from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from wordbase.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(nodes, 2):
        if near(a, b):
            root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for text in ["", "One", "one TWO", "a b c", "a  b\tc\nd e f a b c", "É é x " * 50]:
        assert simhash.fingerprint(text.encode()) == brute_print(text)


@pytest.mark.parametrize("radius", [1, 3])
def test_links(spark, radius):
    rng = random.Random(radius)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):  # chains, dense groups and differences within one block
            bits = rng.sample(range(64), rng.randint(0, 5)) if rng.random() < 0.5 else [rng.randrange(4) * 16 + b for b in rng.sample(range(16), 3)]
            prints.add(base ^ sum(1 << b for b in set(bits)))
    prints |= {0, 1, (1 << 64) - 1}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long"), radius).collect()

    def near(a, b):
        return ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius

    assert all(near(r["a"], r["b"]) for r in links)
    joined = {(r["a"], r["b"]) for r in links}
    got = brute_components(signed, lambda a, b: (a, b) in joined or (b, a) in joined)
    want = brute_components(signed, near)

    def groups(roots):
        return sorted(sorted(n for n in roots if roots[n] == r) for r in set(roots.values()))

    assert groups(got) == groups(want)


def test_a_dense_group_costs_its_size():
    prints = np.unique(np.random.default_rng(1).integers(0, 1 << 12, 4000).astype(np.uint64))
    keys, rest = simhash._emit(prints, 3)
    own = simhash._emitted_by(keys, rest)
    assert set(own.tolist()) == set(prints.tolist())
    a, _ = simhash._collisions(keys, own, 3)
    assert len(a) < 40 * len(keys)


def test_near_copies(table):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(15):
        base = rng.choices(words, k=400)
        for _ in range(6):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(n, None), (n + 1, "  "), (n + 2, "Word"), (n + 3, "word"), (None, "word"), (None, "alone")]
    prints = {t: brute_print(t) for _, t in rows}
    roots = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    smallest = {}
    for i, t in rows:
        if i is not None:
            smallest[roots[prints[t]]] = min(i, smallest.get(roots[prints[t]], i))
    want = [(i, f"{prints[t]:016x}", smallest.get(roots[prints[t]])) for i, t in rows]
    got = [tuple(r)[:3] for r in simhash.near_copies(table(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = {r["doc_id"] for r in simhash.drop_near_copies(table(rows)).collect()}
    assert kept == {None} | {i for i, _, c in want if i == c and i is not None}


def test_awkward_rows(awkward, empty):
    assert simhash.near_copies(awkward).count() == awkward.count()
    assert simhash.near_copies(empty).count() == 0
    assert simhash.drop_near_copies(empty).columns == empty.columns
    with pytest.raises(ValueError):
        simhash.near_links(awkward.select("fp"), 4)
