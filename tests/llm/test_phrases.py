from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wordbase.llm import phrases


def brute(rows, words=3, least=10, top=2000, percent=50):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, words + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, own in f.items():
        many = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in many.items():
            inside = any(100 * b >= percent * a for q, b in many.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not inside:
                score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def texts_of(rng, n):
    names = [w + s for w in ("the", "Of", "new", "york", "city", "\u00e9t\u00e9", "\U0001f600", "a\u00a0b", "x\x1cy") for s in ("", "", "s")]
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ; ", "\x0b", ":", "!?"]
    return [
        ("".join(w + rng.choice(marks) for w in rng.choices(names, weights=range(len(names), 0, -1), k=rng.randint(0, 60))), rng.choice(["en", "en", "fr", None, "und", "a\nb"]))
        for _ in range(n)
    ]


@pytest.mark.parametrize(("group_words", "words"), [(1_000_000, 3), (200, 3), (20, 3), (3, 3), (1, 3), (50, 2), (30, 4)])
def test_against_brute_force(spark, table, group_words, words):
    """Whatever the size of groups, down to every prefix extended to its full depth."""
    rows = texts_of(random.Random(group_words), 200)
    docs = table([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    got = phrases.collocations(docs, words=words, group_words=group_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, words)
    assert rows_of(got) == want and want


def test_blocks_of_few_words(monkeypatch):
    """Phrases across the borders of blocks and slices are counted once, those across pieces and documents never."""
    rows = texts_of(random.Random(8), 20) + [("new york city " * 300, "en"), ("one, two", "en")] * 3
    seen = Counter()
    for depth, block_words, slice_ in ((3, 1, 1), (3, 7, 5), (2, 4, 1 << 20), (3, 10**6, 11)):
        monkeypatch.setattr(phrases, "BLOCK_WORDS", block_words)
        monkeypatch.setattr(phrases, "SLICE", slice_)
        batch = pa.RecordBatch.from_arrays([pa.array([x[1] or "und" for x in rows]), pa.array([x[0] for x in rows])], names=["lang", "text"])
        total = Counter()
        for block, columns in phrases.blocks(iter([batch]), depth, None):
            leaves, n = phrases.counted(columns, block.below)
            for row, times in zip(leaves.tolist(), n.tolist(), strict=True):
                total[block.names_of[row[0] - 1][1], tuple(block.names_of[i - 1][0] for i in row if i)] += times
        if depth == 3:
            assert not seen or total == seen
            seen = total
    assert seen[b"en", (b"york", b"city", b"new")] >= 299 and not any((b"one", b"two") == phrase[:2] for _, phrase in seen)


@pytest.mark.parametrize("below", [7, 1 << 20, 1 << 21])
def test_counts_of_rows(below):
    """Rows whose number fits give it back; the others are found by their place."""
    rng = random.Random(below)
    some = [rng.randrange(below) for _ in range(4)] + [0, below - 1]
    rows = [tuple(rng.choice(some) for _ in range(3)) for _ in range(500)]
    found, times = phrases.counted([np.array(c, np.int32) for c in zip(*rows, strict=True)], below)
    assert list(zip(map(tuple, found.tolist()), times.tolist(), strict=True)) == sorted(Counter(rows).items())


def test_extended_prefixes_are_looked_up_not_the_leaves(monkeypatch):
    """The few extended phrases are looked for among the numbers of a block; its many leaves are never spelled out."""
    block = phrases.Block(3)
    for lang, text in ((b"en", b"new york city new york"), (b"a\nb", b"new york new"), (b"en", b"city")):
        block.add(lang, text.split())
        block.end()
    leaves, _ = phrases.counted(block.suffixes(True, None), block.below)
    names = [[block.names_of[i - 1] for i in row if i] for row in leaves.tolist()]
    hot = [{b"new\nen": 9, b"york\na\nb": 9, b"gone\nen": 9, b"new\nfr": 9}, {b"new york\nen": 9, b"york new\na\nb": 9, b"new gone\nen": 9}]

    def level(row):
        for depth, own in enumerate(hot, 1):
            if phrases.named(b" ".join(w for w, _ in row[:depth]), row[0][1]) not in own:
                return depth
            if len(row) == depth:
                return 0
        return 3

    monkeypatch.setattr(phrases.Block, "names", None)
    assert phrases.extended(block, leaves, hot).tolist() == [level(row) for row in names]


def test_ranks(spark):
    """Ties go by count and then by phrase; each language has its own ranks, however long."""
    rng = random.Random(2)
    rows = [(lang, f"p{rng.random()}", rng.randint(10, 12), rng.choice([5, 7])) for lang in ["a"] * 3000 + ["b", "c"] * 40 for _ in range(1)]
    table = spark.createDataFrame(rows, "lang string, phrase string, a long, score long").repartition(16)
    for top in (1, 100, 5000):
        got = sorted((r["lang"], r["rank"], r["phrase"]) for r in phrases.ranked(table, top).collect())
        want = []
        for lang in "abc":
            own = sorted((-s, -a, p) for x, p, a, s in rows if x == lang)[:top]
            want += [(lang, i, p) for i, (_, _, p) in enumerate(own, 1)]
        assert got == sorted(want)


def test_a_full_bitmap_changes_nothing(spark, table, monkeypatch):
    rows = texts_of(random.Random(11), 100)
    monkeypatch.setattr(phrases, "BITMAP_BITS", 6)
    assert rows_of(phrases.collocations(table([(i, t, lang) for i, (t, lang) in enumerate(rows)]), least=3)) == brute(rows, least=3)


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    made = [("en", "x", 1, big + 1, []), ("en", "y", 1, big + 2, []), ("en", "x y", 2, big, [big + 1])]
    (row,) = phrases.scored(spark.createDataFrame(made, phrases.NODES)).collect()
    assert row["score"] == 1_000_000 * big * big // ((big + 1) * (big + 2))


def test_awkward_rows(spark, awkward, empty):
    rows = [(r["text"], r["lang"]) for r in awkward.collect()]
    assert rows_of(phrases.collocations(awkward)) == brute(rows)
    assert phrases.collocations(empty).collect() == []


def test_hot_word(spark, table):
    """One word and one phrase hold most places."""
    rng = random.Random(6)
    rows = [(" ".join(rng.choice(["hot", "hot", "hot", "hot hot word", f"w{rng.randint(0, 30)}"]) for _ in range(200)), "en") for _ in range(60)]
    docs = table([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    for group_words in (1_000_000, 500):
        assert rows_of(phrases.collocations(docs, group_words=group_words)) == brute(rows)
