from __future__ import annotations

import random

import pytest

from wordbase.llm import decontaminate
from wordbase.llm.decontaminate import CAPITAL, LITERAL, NAME, NUMBER, UNIT, classify


@pytest.fixture(scope="module")
def items(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")

    return make


QUESTION = "Natalia sold 48 clips to friends in April and then sold half as many clips in May so how many did Natalia sell in 2 months"
RNG = random.Random(1)
FILLER = [f"word{i}x" for i in range(500)]


def around(text, n=40):
    return " ".join([*RNG.choices(FILLER, k=n), text, *RNG.choices(FILLER, k=n)])


def found(table, items, docs, benchmark):
    rows = decontaminate.contaminated(table(docs), items(benchmark)).collect()
    return {(r["doc_id"], r["item_id"]): round(r["share"], 3) for r in rows}


def test_kinds_of_words():
    kinds = {"48": NUMBER, "3,000.5": NUMBER, "(12th)": NUMBER, "seven": NUMBER, "km": UNIT, "Natalia,": NAME, "April": CAPITAL, "april": LITERAL, "USA": LITERAL, "a1": LITERAL}
    assert {w: classify(w)[0] for w in kinds} == kinds
    assert classify("end.")[2] and classify('end."')[2] and not classify("e.g")[2]


def test_passages_however_written(table, items):
    docs = [
        (1, around(QUESTION)), (2, around(QUESTION.upper())), (3, around(QUESTION.replace(" ", "\n "))), (4, around(" ".join(w + "***" for w in QUESTION.split()))),
        (5, around("clean")), (6, QUESTION), (7, around(" ".join(QUESTION.split()[:20]))), (8, around(" ".join(QUESTION.split()[:11]))),
    ]
    got = found(table, items, docs, [(1, QUESTION)])
    assert set(got) == {(i, 1) for i in (1, 2, 3, 4, 6, 7)}
    assert got[1, 1] == got[2, 1] == 1.0


def test_changed_slots_must_agree(table, items):
    asked = "Tom has 3 apples and then Bob gives Tom 3 pears so now Tom has six fruits of which he eats 3 after a walk of 5 km with Bob and a friend"
    changed = asked.replace("Tom", "Emma").replace("Bob", "Karen").replace("3", "17").replace("5 km", "9 miles").replace("six", "34")
    clash = changed.replace("Emma 17 pears", "Emma 18 pears")  # one value of the item, two of the document
    merged = changed.replace("Karen", "Emma")  # two values of the item, one of the document
    docs = [(1, around(changed)), (2, around(clash)), (3, around(merged)), (4, around(asked))]
    got = found(table, items, docs, [(9, asked)])
    assert (1, 9) in got and (4, 9) in got and got[1, 9] == 1.0
    assert (2, 9) not in got and (3, 9) not in got


def test_against_brute_force(table, items):
    """Without slots, the share is that of the item's windows of eight words that a document has."""
    rng = random.Random(7)
    words = [f"w{c}" for c in "abcdefghijkl"]
    benchmark = [(i, " ".join(rng.choices(words[:6], k=rng.randint(4, 20)))) for i in range(8)]
    docs = []
    for d in range(60):
        own = rng.choices(words[:6], k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(benchmark)[1].split()
            own[3:3] = passage[rng.randint(0, 3) : rng.randint(6, 20)]
        docs.append((d, " ".join(own)))

    def windows(text, n):
        w = text.split()
        return [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]

    want = {}
    for d, t in docs:
        for i, q in benchmark:
            n = min(8, len(q.split()))
            own, has = windows(q, n), set(windows(t, n))
            share = sum(w in has for w in own) / len(own)
            if share >= 0.5:
                want[d, i] = round(share, 3)
    assert found(table, items, docs, benchmark) == want and len(want) > 10


def test_awkward_rows(table, items, awkward, empty):
    none = items([])
    assert decontaminate.contaminated(awkward, none).count() == 0
    assert decontaminate.contaminated(empty, items([(1, QUESTION)])).count() == 0
    odd = items([(None, QUESTION), (1, None), (2, ""), (3, "the cat sat the cat sat the cat"), (4, "one two"), (5, QUESTION), (6, "the cat sat the")])
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(awkward, odd).collect()}
    assert got == {(9, 3), (9, 6)}
    kept = decontaminate.drop_contaminated(awkward, odd)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 1
    assert found(table, items, [(None, QUESTION), (1, "x")], [(7, QUESTION), (5, QUESTION)]) == {(None, 5): 1.0}


def test_few_own_words_and_unlisted_names(table, items):
    asked = "Olivia runs 5km every day. Olivia swims 2km on weekends. Olivia rests twice a week."
    benchmark = [(1, "What is 47 + 58 ?"), (2, "Compute 12 * 14 + 3 ."), (3, asked), (4, "Lara is a five-year-old girl with twenty-five red cups."), (5, "7 8 9 10")]
    docs = [
        (1, around("What is 31 + 76 ?")), (2, around("Compute 9 * 8 + 2 .")), (3, around("end. " + asked.replace("Olivia", "Zoe").replace("5", "7").replace("2", "3"))),
        (4, around("end. Mira is a 6-year-old girl with 31 red cups.")), (5, around("1 2 3 4 5 6")),
        (6, around("end. " + asked.replace("Olivia", "Zoe", 2).replace("Olivia", "Mira"))), (7, around("What are 31 + 76 ?")),
        (8, around("yesterday Zoe runs 7 km every day. Zoe swims 3 km on weekends. Zoe rests twice a week.")),
    ]
    got = found(table, items, docs, benchmark)
    assert got == {(1, 1): 1.0, (2, 2): 1.0, (3, 3): 1.0, (4, 4): 1.0, (8, 3): 1.0}


def test_parted_words():
    parted = decontaminate.parted
    assert parted("(5km),") == ("(5", "km),") and parted("5-year-old") == ("5", "year-old") and parted("twenty-year") == ("twenty", "year")
    assert [parted(w) for w in ("12th", "a1", "3,000.5", "twenty-five", "7-8", "-", "x-ray")] == [(w, "") for w in ("12th", "a1", "3,000.5", "twenty-five", "7-8", "-", "x-ray")]
    assert classify("twenty-five")[0] == NUMBER and classify("x-ray")[0] == LITERAL


def test_slot_heavy_windows_count_with_the_whole_item(table, items):
    asked = "the sum of the numbers 3 4 5 6 7 8 9 10 11 12 is what we ask for here"
    other = "the sum of the numbers 23 24 25 26 27 28 29 30 31 32 is what we ask for here"
    docs = [(1, around(other)), (2, around(" ".join(other.split()[4:16]))), (3, around(" ".join(str(i) for i in range(40, 70))))]
    assert found(table, items, docs, [(1, asked)]) == {(1, 1): 1.0}


def test_scripts_without_spaces(table, items):
    asked = "小明有三个苹果他又买了五个苹果然后给了小红两个请问他还剩几个"
    thai = "สมชายมีแอปเปิลสามผลแล้วซื้อเพิ่มอีกห้าผล"
    docs = [(1, "今天天气很好。" + asked + "我们去公园吧"), (2, "今天天气很好我们去公园吧"), (3, "x " + thai + " y"), (4, asked[:6] + "不同的内容在这里继续写下去")]
    assert found(table, items, docs, [(1, asked), (2, thai)]) == {(1, 1): 1.0, (3, 2): 1.0}


def test_short_items_and_long_runs(table, items):
    long = [f"passage{i}y" for i in range(500)]
    docs = [(1, around(" ".join(long[100:340]))), (2, around(" ".join(long[100:149]))), (3, around(" ".join(long[100:150]))), (4, around("Quoth the raven")), (5, around("quoth raven the"))]
    got = found(table, items, docs, [(1, " ".join(long)), (2, "Quoth the raven?")])
    assert got == {(1, 1): round(233 / 493, 3), (3, 1): round(43 / 493, 3), (4, 2): 1.0}


def numbers(rng, n):
    return " ".join(str(rng.randint(100, 99_999)) for _ in range(n))


def test_runs_of_slots(table, items):
    """Items with more numbers in a row than a window has words: found whole wherever the run stands, with agreeing values only."""
    rng = random.Random(21)
    a, b, c, d = (numbers(rng, k) for k in (12, 20, 9, 8))
    benchmark = [
        (1, f"the readings of the long winter were {a} as the log of the old station says"), (2, f"{b} are the values that she wrote down in her book"),
        (3, f"please add all of these numbers up for me now {c}"), (4, f"first we saw {d} then came {d} and after that it was over"),
    ]
    a2, b2, c2, d2, e2 = (numbers(rng, k) for k in (12, 20, 9, 8, 8))
    other = lambda i, old, new: benchmark[i - 1][1].replace(old, new)
    docs = [
        (1, around(other(1, a, a2))), (2, around(other(2, b, b2))), (3, around(other(3, c, c2))), (4, around(other(4, d, d2))),
        (5, numbers(rng, 30) + " " + other(2, b, b2)), (6, other(3, c, c2) + " " + numbers(rng, 30)),  # the document's run is longer
        (7, around(benchmark[3][1].replace(d, d2, 1).replace(d, e2))),  # other values at its second place
        (8, around(other(2, b, b2.split(" ", 3)[3]))),  # the run is too short
        (9, around(other(3, c, " ".join(c2.split()[:5] + ["Emma"] + c2.split()[6:])))),  # a name among the numbers
        (10, around(numbers(rng, 200))), (11, around(a)), (12, around(benchmark[0][1])), (None, other(1, a, a2)),
    ]
    got = found(table, items, docs, benchmark)
    whole = {k for k, share in got.items() if share == 1.0}
    assert whole == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 2), (6, 3), (12, 1), (None, 1)}
    # (9, 3) holds half of the item's windows in the words before the numbers
    assert set(got) - whole <= {(7, 4), (9, 3), (11, 1)}


def test_tables_of_numbers_meet_nobody(spark, table, items, monkeypatch):
    """An item of many numbers and documents of thousands: what is joined does not grow with both."""
    rng = random.Random(22)
    item = f"the table of the year reads {numbers(rng, 40)} in all"
    docs = [(i, f"the table of the year shows {numbers(rng, 5000)} or so") for i in range(3)] + [(9, item.replace("year", "year")), (10, numbers(rng, 5000) + " " + item)]
    kept = {}
    stored = decontaminate.stored

    def counting(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(decontaminate, "stored", counting)
    assert found(table, items, docs, [(1, item)]) == {(9, 1): 1.0, (10, 1): 1.0}
    assert kept["found_windows"].count() < 500 and kept["seen_windows"].count() < 600


def test_plain_words_need_no_patterns(monkeypatch):
    """Words of letters, with one mark after them at most, are known without the patterns that others need, as the patterns have them."""
    bare = ["ten", "Ten", "km", "Anna", "anna", "House", "HOUSE", "hOUSE", "A", "a", "\u00e9t\u00e9", "\u00c9t\u00e9", "\u0130x", "\u1e9eu", "\u4e2d", "\u01c5a", "\u00aa", "twenty"]
    plain = [w + mark for w in bare for mark in ("", ".", ",", ";", ":", "!", "?")]
    others = ["5km", "x1", "1", "-", ".", "?", "a-b", "five-day", "(a", "a)", "a..", "a,.", "\u2160", "\u00bd", "a_", "_", "don't", decontaminate._BREAK, "a\u0301", "'a'"]
    want = {w: (*decontaminate.classify(decontaminate.parted(w)[0]), decontaminate.parted(w)[1]) for w in plain + others}
    asked = []
    monkeypatch.setattr(decontaminate, "classify", lambda word, of=decontaminate.classify: asked.append(word) or of(word))
    known = decontaminate._Known()
    for w, (kind, value, ends, rest) in want.items():
        at = known[w]
        assert (known.kind[at], known.hash[at], known.ends[at]) == (kind, value, ends), w
        assert known.glued[at] == (known[rest] if rest else -1), w
    assert not set(asked) & set(plain)
