from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD
from tests.llm.test_simhash import brute_components
from wordbase.llm import line_dedup


def edits(x, y):
    row = list(range(len(x) + 1))
    for j, c in enumerate(y, 1):
        new = [j]
        for i, d in enumerate(x, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != d)))
        row = new
    return row[-1]


def changed(rng, line, n):
    line = list(line)
    for _ in range(n):
        at, kind = rng.randrange(len(line) + 1), rng.choice("sid")
        if kind == "i":
            line.insert(at, rng.choice("abcé"))
        elif line and at < len(line):
            if kind == "d":
                del line[at]
            else:
                line[at] = rng.choice("abcé")
    return "".join(line)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_distance(spark, threshold):
    rng = random.Random(threshold)
    pairs = []
    for _ in range(300):
        x = "".join(rng.choices("abcé", k=rng.randint(0, 30)))
        pairs.append((x, changed(rng, x, rng.randint(0, 5))))
    pairs += [("", ""), ("", "a"), ("a", ""), ("abc", "abcde"), ("abcde", "abc"), ("😀b", "😀c")]
    table = spark.createDataFrame(pairs, "x string, y string")
    got = table.select("x", "y", line_dedup.within(F.col("x"), F.col("y"), threshold).alias("near")).collect()
    assert [r["near"] for r in got] == [edits(r["x"], r["y"]) <= threshold for r in got]


@pytest.mark.parametrize("threshold", [1, 2])
@pytest.mark.parametrize("long_list", [2, 10_000])
def test_classes(table, monkeypatch, threshold, long_list):
    monkeypatch.setattr(line_dedup, "LONG_LIST", long_list)
    monkeypatch.setattr(line_dedup, "LONG_LINE", 60)
    rng = random.Random(threshold)
    bases = ["".join(rng.choices("abcé ", k=rng.choice([18, 20, 21, 30, 47, 80]))) for _ in range(25)]
    docs = []
    for d in range(80):
        lines = [changed(rng, rng.choice(bases), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randint(0, 6))]
        docs.append((d, "\n".join([*lines, *rng.choices(["", "  ", "short", "shorx"], k=2)])))
    docs += AWKWARD
    lines = [(n, i, k, x) for n, (i, t) in enumerate(docs) for k, x in enumerate((t or "").split("\n"))]
    texts = sorted({x for *_, x in lines if x.strip(" \t\r\v\f")})

    def near(a, b):
        return min(len(a), len(b)) >= line_dedup.LEAST_CHARS and abs(len(a) - len(b)) <= threshold and edits(a, b) <= threshold

    roots = brute_components(texts, near)
    first = {}
    for n, i, k, x in lines:
        if x in roots:
            place = (i is None, i if i is not None else 0, n, k)
            first[roots[x]] = min(first.get(roots[x], place), place)
    want = []
    for n, (i, t) in enumerate(docs):
        own = (t or "").split("\n")
        gone = []
        for k, x in enumerate(own):
            if x in roots and first[roots[x]][2:] != (n, k):
                head = first[roots[x]]
                gone.append((k, None if head[0] else head[1], head[3]))
        want.append((i, len(own), len(own) - len(gone), gone))
    # rows with equal ids and texts may come in any order
    rows = line_dedup.line_report(table(docs).coalesce(1), threshold).collect()
    got = [(r["doc_id"], r["n_lines"], r["n_kept"], [tuple(x) for x in r["dropped"]]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(g[3] for g in got)


def test_look_ups_find_a_whole_segment():
    """Of any two lines within the threshold, an entry of the shorter is looked up by the longer."""
    rng = random.Random(3)
    for threshold in (1, 2, 3):
        places = [(0, i, 0) for i in range(threshold + 1)] + line_dedup.look_ups(threshold)

        def part(n, i, threshold=threshold):
            base, over = divmod(n, threshold + 1)
            return base * i + max(0, over - (threshold + 1 - i)), base + (i >= threshold + 1 - over)

        for _ in range(500):
            x = "".join(rng.choices("ab", k=rng.randint(4, 14)))
            y = changed(rng, x, rng.randint(1, threshold))
            x, y = sorted((x, y), key=len)
            if edits(x, y) > threshold:
                continue
            index = {(i, len(x), x[s : s + z]) for i in range(threshold + 1) for s, z in [part(len(x), i)]}
            asked = set()
            for less, i, shift in places:
                s, z = part(len(y) - less, i)
                if 0 <= s + shift and s + shift + z <= len(y):
                    asked.add((i, len(y) - less, y[s + shift : s + shift + z]))
            assert index & asked


def test_texts_without_repeats(table):
    rows = [(1, "a line of some length\nb\n\nb"), (2, "a line of some lengths\nc"), (2, "a line of some lengths\nc"), (3, None)]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.without_repeats(table(rows)).collect())
    assert got == [(1, "a line of some length\nb\n"), (2, ""), (2, "c"), (3, "")]


def test_empty_and_native(table, empty):
    assert line_dedup.line_report(empty).count() == 0
    plan = line_dedup.line_report(table([(1, "a line of some length"), (2, "b line of some length")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_combinations_are_bounded():
    assert [len(line_dedup.look_ups(t)) for t in (1, 2)] == [2, 9]
    assert len(list(combinations(range(4), 2))) == 6


def test_lines_on_both_sides_of_the_border(table, monkeypatch):
    """A crowd of lines of the longest length that is not paired, and one with a character more."""
    monkeypatch.setattr(line_dedup, "LONG_LIST", 2)
    monkeypatch.setattr(line_dedup, "LONG_LINE", 60)
    base = "".join(random.Random(4).choices("abcdefgh", k=60))
    lines = [base, *(base[:30] + c + base[31:] for c in "wxyz"), base[:10] + "." + base[10:], base[:10] + "." + base[10:20] + "!" + base[21:]]
    rows = line_dedup.line_report(table(list(enumerate(lines)))).collect()
    assert sorted((r["doc_id"], r["n_kept"]) for r in rows) == [(0, 1), *((i, 0) for i in range(1, len(lines)))]
