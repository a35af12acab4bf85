from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD
from wordbase.llm import language

SF = "/root/testdata/sf0.01"


def brute_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    letters = " ".join(letters.split()).encode()
    if not letters:
        return set()
    b = b" " + letters + b" "
    return {b[i : i + n] for n in range(1, 5) for i in range(len(b) - n + 1)}


def test_grams():
    for text in ["", "12 ..", "Ab, ab!", "été à l'école", "中文 a", "x" * 500]:
        assert {int(g).to_bytes(4, "big").lstrip(b"\0") for g in language.grams(text)} == brute_grams(text)


def test_folded_product_is_the_kernel_machine(spark):
    """Prediction by folded weights equals the kernels with the landmarks, whitened and regressed."""
    rng = random.Random(1)
    words = {"a": ["la", "le", "que", "rien"], "b": ["the", "and", "thing"], "c": ["und", "nicht", "sich"]}
    rows = [(lang, " ".join(rng.choices(words[lang], k=rng.randint(1, 9)))) for lang in words for _ in range(30)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    sample = language.sampled(docs)
    assert len(sample) == 90
    model = language.fit(docs, landmarks=20, ridge=1e-2)
    marks = [g for _, g in sample[:20]]

    def kernel(a, b):
        return len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b))

    k_mm = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(k_mm)
    kept = values > 1e-6 * values[-1]
    white = vectors[:, kept] / np.sqrt(values[kept])

    def features(grams):
        return np.append(np.array([kernel(grams, m) for m in marks]) @ white, 1.0)

    x = np.array([features(g) for _, g in sample])
    y = np.array([[1.0 if lang == c else -1.0 for c in "abc"] for lang, _ in sample])
    penalty = np.diag([1e-2 * len(x)] * (x.shape[1] - 1) + [1e-9])
    solved = np.linalg.solve(x.T @ x + penalty, x.T @ y)
    texts = [language.grams(t) for t in ["la chose", "the thing is", "und so", "zzz"]]
    want = np.array([features(g) @ solved for g in texts])
    assert np.allclose(model.scores(texts), want, atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.fit(docs.where(~fold))
    out = docs.where(fold).select("lang", language.language(docs, model).alias("g"))
    right, n, low = out.agg(F.avg((F.col("lang") == F.col("g.lang")).cast("int")), F.count("*"), F.min("g.score")).first()
    assert n > 300 and right > 0.98
    assert low >= language.LEAST_SCORE
    assert language.drop_unknown(docs, model).count() == docs.count()


def test_awkward_rows(spark, awkward, empty, table):
    known = table([(i, "le la que rien", "fr") for i in range(5)] + [(9, "the and of", "en"), (10, "zz", None)])
    model = language.fit(known)
    assert model.labels == ["en", "fr"]
    got = awkward.select("doc_id", "text", language.language(awkward, model).alias("g")).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["g"]["lang"] == "und") == (not letters)
        assert 0 <= r["g"]["score"] <= 1 and (letters or r["g"]["score"] == 0)
    kept = language.drop_unknown(awkward, model)
    assert kept.columns == awkward.columns
    assert language.fit(empty) is None and language.fit(awkward) is None
    assert {r[0]["lang"] for r in awkward.select(language.language(awkward, None)).collect()} == {"und"}
    assert language.drop_unknown(empty, model).count() == 0


def test_prediction_reads_the_text_alone(spark, table):
    model = language.fit(table([(1, "le la que", "fr"), (2, "the and of", "en")]))
    rows = table([(1, "the and", "fr"), (99, "the and", None), (None, "the and", "xx")])
    assert len({tuple(r[0]) for r in rows.select(language.language(rows, model)).collect()}) == 1


def invented(rng, language, words):
    """A text of a language that prefers syllables of its own."""
    own = random.Random(language)
    syllables = ["".join(own.choices("bcdfghklmnprstvz", k=1) + own.choices("aeiou", k=1) + own.choices("nrst ", k=1)) for _ in range(40)]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))).replace(" ", "") for _ in range(words))


def test_every_label_is_learned(table):
    """More labels than the former bound and than weights are folded for, one with a single row."""
    rng = random.Random(5)
    names = [f"l{i:02}" for i in range(90)]
    rows = [(n * 100 + i, invented(rng, n, 150), lang) for n, lang in enumerate(names) for i in range(1 if n == 7 else 4)]
    model = language.fit(table(rows))
    assert model.labels == names
    asked = table([(n, invented(rng, n, 100)) for n in range(90)])
    got = {r["doc_id"]: r["g"]["lang"] for r in asked.select("doc_id", language.language(asked, model).alias("g")).collect()}
    assert sum(got[n] == lang for n, lang in enumerate(names)) >= 88 and got[7] == "l07"


def test_folded_and_unfolded_weights_agree(table, monkeypatch):
    rng = random.Random(6)
    docs = table([(n * 100 + i, invented(rng, n, 60), f"l{n}") for n in range(5) for i in range(6)])
    texts = [language.grams(invented(rng, n, 30)) for n in range(8)] + [language.grams("")]
    folded = language.fit(docs).scores(texts)
    monkeypatch.setattr(language, "FOLDED", 2)
    assert np.allclose(language.fit(docs).scores(texts), folded, atol=1e-4)


def test_unlearned_texts_go_and_short_clean_ones_stay(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    foreign = [
        "Tämä on suomenkielinen lause jota kukaan ei ole opettanut mallille", "Ovo je rečenica na hrvatskom jeziku koju model ne poznaje",
        "これは日本語の文章です", "Це речення українською мовою",
        "xkq zvw qqpz 8273 jjx wvq kkzx vvqw pxq zzkj qxv jwkq", "1234 5678 --",
    ]
    clean = [(100, "the that of"), (101, "der und die ist"), (102, "que la de los")]
    clean += [(103, 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" From reha reenti oution thti.')]
    kept = {r["doc_id"] for r in language.drop_unknown(table([*enumerate(foreign), *clean]), model).collect()}
    assert kept == {100, 101, 102, 103}

    rng = random.Random(8)
    many = language.fit(table([(n * 100 + i, invented(rng, n, 80), f"l{n}") for n in range(30) for i in range(25)]))
    short = [(n, invented(rng, n, 6)) for n in range(30) for _ in range(20)]
    assert language.drop_unknown(table(short), many).count() == 600
    assert language.drop_unknown(table(list(enumerate(foreign))), many).count() == 0


def test_numbers_are_no_letters():
    """Numbers of all kinds are none, so the fit's letters and those of a prediction are the same."""
    for text in ("\u00bd \u00b2 \u2167 \u2460", "12 \u0663 _", "\u3007\u2028", "\u4e00"):
        assert (len(language.grams(text)) > 0) == any(c.isalpha() for c in text), text
    assert language.grams("a\u00bdb").tolist() == language.grams("a b").tolist() == language.grams("a1b").tolist()


@pytest.mark.parametrize("folded", [64, 0])
def test_batches_score_as_single_texts(spark, monkeypatch, folded):
    """Whatever the blocks, with empty and unknown texts among them, scores are those of the kernel with each landmark."""
    rng = random.Random(12)
    words = {"x": ["abba", "cada", "bac"], "y": ["zyx", "yzy", "xoz"], "z": ["mnm", "nono", "mon"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 30))), lang) for i, lang in enumerate("xyz" * 20)]
    monkeypatch.setattr(language, "FOLDED", folded)
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=60, landmarks=20)
    texts = [language.grams(t) for t in ["", "qqqq", *(r[1] for r in rows[:25]), "", "abba zyx mon", "\u4e2d"]]
    single = np.concatenate([model.scores([own]) for own in texts])
    for block in (1, 50, 10**6):
        monkeypatch.setattr(language, "BLOCK", block)
        assert np.allclose(model.scores(texts), single, atol=1e-9)
    if not folded:
        by_hand = np.stack([model.intercept + (model.marks.kernel(own) @ model.weights if len(own) else 0) for own in texts])
        assert np.allclose(single, by_hand, atol=1e-6)
    assert model.scores([]).shape == (0, 3)
