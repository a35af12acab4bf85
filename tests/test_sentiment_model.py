"""The fitted model of sentiments, and labels spread along relations."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wordbase.operators import propagation, sentiment, sentiment_model
from wordbase.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


def words_of(rng, n):
    """Words whose ending mostly tells the label."""
    made = {}
    while len(made) < n:
        stem = "".join(rng.choices("abcdeghiklmnoprst", k=rng.randint(2, 7)))
        ending = rng.choice(["ful", "ious", "less", "ache"])
        label = "positive" if ending in ("ful", "ious") else "negative"
        made[stem + ending] = label if rng.random() < 0.95 else "negative"
    return sorted(made.items())


@pytest.fixture(scope="module")
def fitted(spark):
    rows = words_of(random.Random(1), 1500)
    learnt = [r for i, r in enumerate(rows) if i % 5]
    held = [r for i, r in enumerate(rows) if not i % 5]
    table = spark.createDataFrame(learnt + [("neutralword", "neutral"), (None, "positive"), ("nolabel", None)], "word string, label string")
    return sentiment_model.fit(table), held, table


def test_held_out_words(spark, fitted):
    model, held, _ = fitted
    (row,) = sentiment_model.report(spark.createDataFrame(held, "word string, label string"), model).collect()
    assert row["words"] == 300 and row["right"] > 0.9 * 300 > 1.3 * row["most_frequent"]


def test_the_same_rows_give_the_same_model(spark, fitted):
    model, held, table = fitted
    again = sentiment_model.fit(table.repartition(5))
    words = spark.createDataFrame(held, "word string, known string")
    ours, theirs = (dict((r["word"], (r["label"], round(r["score"], 6))) for r in sentiment_model.predicted(words, m).collect()) for m in (model, again))
    assert ours == theirs


def grams(word):
    marked = f"^{word}$"
    return {marked[i : i + n] for n in range(1, 5) for i in range(max(1, len(marked) - n + 1))}


def test_scores_are_those_of_the_coefficients(spark, fitted):
    model, held, _ = fitted
    hashing, regression = model.stages
    for row in sentiment_model.predicted(spark.createDataFrame([(w,) for w, _ in held[:50]] + [("",), (None,)], "word string"), model).collect():
        places = {hashing.indexOf(g) for g in grams(row["word"] or "")}
        positive = 1 / (1 + math.exp(-regression.intercept - sum(regression.coefficients[p] for p in places)))
        assert row["label"] == ("positive" if positive >= 0.5 else "negative")
        assert math.isclose(row["score"], max(positive, 1 - positive), abs_tol=1e-9)


def test_saved_and_used_as_a_scorer(spark, fitted, tmp_path):
    model, held, _ = fitted
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    counts = spark.createDataFrame([(w, i) for i, (w, _) in enumerate(held)], "word string, count long")
    scored = sentiment.score_sentiment(counts, loaded)
    assert scored.columns == ["word", "count", "sentiment", "sentiment_score"] and scored.count() == len(held)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    neutral = scored.where("sentiment = 'neutral'")
    assert neutral.where("sentiment_score <> 0.5").count() == 0
    assert scored.where("sentiment <> 'neutral' AND sentiment_score < 0.7").count() == 0


def test_weights_count(spark):
    rows = [("aaa", "positive", 1.0), ("aaa", "negative", 50.0), ("bbb", "positive", 1.0), ("bbb", "negative", 0.01)]
    model = sentiment_model.fit(spark.createDataFrame(rows, "word string, label string, weight double"))
    got = {r["word"]: r["label"] for r in sentiment_model.predicted(spark.createDataFrame([("aaa",), ("bbb",)], "word string"), model).collect()}
    assert got["aaa"] == "negative"


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([("a", "neutral"), (None, "positive")], "word string, label string")
    with pytest.raises(ValueError):
        sentiment_model.fit(none)
    one = sentiment_model.fit(spark.createDataFrame([("a", "negative")], "word string, label string"))
    assert [r["label"] for r in sentiment_model.predicted(spark.createDataFrame([("b",)], "word string"), one).collect()] == ["negative"]


def test_the_registered_model(spark):
    (row,) = QUERIES["sentiment_model_report"](spark, SF).collect()
    assert row["words"] > 1000 and 0 < row["right"] <= row["words"] and row["most_frequent"] * 2 >= row["words"]


# --- labels along relations ------------------------------------------------


def brute(edges, seeds):
    links = {(a, b, 1 if rel == "SYNONYM_OF" else -1) for s, rel, d in edges if rel in ("SYNONYM_OF", "ANTONYM_OF") and s != d for a, b in ((s, d), (d, s))}
    signed, last, n = {w: (s, 0) for w, s in seeds}, dict(seeds), 0
    while last:
        n += 1
        votes = defaultdict(int)
        for a, b, agrees in links:
            if a in last and b not in signed:
                votes[b] += agrees * last[a]
        last = {w: (1 if v > 0 else -1) for w, v in votes.items() if v}
        signed |= {w: (s, n) for w, s in last.items()}
    return sorted((w, s, r) for w, (s, r) in signed.items())


@pytest.mark.parametrize("seed", range(4))
def test_spread_against_brute_force(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(60)]
    rels = ["SYNONYM_OF", "ANTONYM_OF", "HYPERNYM_OF"]
    edges = [(rng.choice(names), rng.choice(rels), rng.choice(names)) for _ in range(70)] + [("n1", "SYNONYM_OF", "n1")]
    edges += [("a", "SYNONYM_OF", "b"), ("b", "SYNONYM_OF", "a"), ("a", "ANTONYM_OF", "b")]  # said twice, and denied
    seeds = [(w, rng.choice([1, -1])) for w in rng.sample(names, 5)] + [("alone", 1), ("a", 1)]
    got = propagation.spread_sentiment(spark.createDataFrame(edges, "src string, rel string, dst string"), spark.createDataFrame(seeds, "word string, sign int"))
    assert sorted(map(tuple, got.collect())) == brute(edges, seeds)


def test_long_chains_ties_and_limits(spark, monkeypatch):
    monkeypatch.setattr(propagation, "WRITE_TOGETHER", 4)
    chain = [(f"c{i}", "ANTONYM_OF" if i % 3 == 0 else "SYNONYM_OF", f"c{i + 1}") for i in range(12)]
    tie = [("p", "SYNONYM_OF", "t"), ("q", "SYNONYM_OF", "t"), ("t", "SYNONYM_OF", "u")]
    edges = spark.createDataFrame(chain + tie, "src string, rel string, dst string")
    seeds = [("c0", 1), ("p", 1), ("q", -1)]
    table = spark.createDataFrame(seeds, "word string, sign int")
    assert sorted(map(tuple, propagation.spread_sentiment(edges, table).collect())) == brute(chain + tie, seeds)
    few = propagation.spread_sentiment(edges, table, rounds=2)
    assert {r["word"] for r in few.collect()} == {"c0", "c1", "c2", "p", "q"}
    assert propagation.spread_sentiment(edges, table.where("false")).count() == 0
    assert sorted(r["word"] for r in propagation.spread_sentiment(edges.where("false"), table).collect()) == ["c0", "p", "q"]


def test_a_hub_votes_in_many_tasks(spark):
    edges = spark.range(0, 40_000).select(F.lit("hub").alias("src"), F.lit("SYNONYM_OF").alias("rel"), F.concat(F.lit("w"), "id").alias("dst"))
    seeds = spark.createDataFrame([("hub", -1)], "word string, sign int")
    reached = propagation.spread_sentiment(edges, seeds)
    assert reached.groupBy("sign", "round").count().orderBy("round").collect() == [(-1, 0, 1), (-1, 1, 40_000)]
