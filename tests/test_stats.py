from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from wordbase.functions.scoring import model_scorer, neutral_band
from wordbase.operators import lookups, sentiment, stats
from wordbase.schemas import FLAT, FREQUENCY, HISTOGRAM, MIRROR, NODE, RECORD, rows_to_table


def flat(spark, *rows):
    """word, count, pos, sentiment"""
    full = [(w, c, "-", p, s, 0.5, "-", "-", "-", "-") for w, c, p, s in rows]
    return rows_to_table(spark, full, FLAT)


def nodes(spark, *rows):
    return rows_to_table(spark, [(n, p, None, None, None) for n, p in rows], NODE)


def test_extremes_break_ties_by_word(spark):
    df = rows_to_table(spark, [("b", 9), ("a", 9), ("d", 1), ("c", 1)], FREQUENCY)
    assert stats.most_common(df).first().word == "a"
    assert stats.least_common(df).first().word == "c"
    missing = df.unionByName(rows_to_table(spark, [("z", None)], FREQUENCY))
    assert stats.least_common(missing).first().word == "z"
    assert stats.most_common(missing).first().word == "a"
    assert stats.most_common(rows_to_table(spark, [], RECORD)).count() == 0


@pytest.mark.parametrize(
    "rows, mean, median",
    [
        ([(1, 1), (4, 1), (9, 1)], 14 / 3, 4.0),
        ([(1, 2), (4, 2)], 2.5, 2.5),
        ([], 0.0, None),
        ([(3, 0), (5, 0)], 0.0, None),
        ([(1, 1), (2, 10**12), (9, 1)], 2.0, 2.0),
    ],
)
def test_mean_and_median(spark, rows, mean, median):
    row = stats.length_summary(rows_to_table(spark, rows, HISTOGRAM)).first()
    assert row.mean_length == pytest.approx(mean)
    assert row.median_length == median


def test_median_agrees_with_repeated_rows(spark):
    rows = [(length, (length * 7) % 5 + 1) for length in range(1, 20)]
    repeated = [length for length, n in rows for _ in range(n)]
    got = stats.median_length(rows_to_table(spark, rows, HISTOGRAM)).first().median_length
    assert got == statistics.median(repeated)


def test_length_histogram_counts_nodes_in_order(spark):
    df = nodes(spark, ("aa", None), ("bb", None), ("é", None), ("abcd", None))
    assert [tuple(r) for r in stats.length_histogram(df).collect()] == [(1, 1), (2, 2), (4, 1)]


def test_neutral_band_is_open(spark):
    df = spark.createDataFrame([(s,) for s in (0.3, 0.31, 0.5, 0.69, 0.7)], "s double")
    label, score = neutral_band(F.lit("positive"), F.col("s"))
    got = [tuple(r) for r in df.select(label, score).collect()]
    assert got == [("positive", 0.3), ("neutral", 0.5), ("neutral", 0.5), ("neutral", 0.5), ("positive", 0.7)]


def test_proportions_cover_the_closed_domain(spark):
    df = flat(spark, ("a", 1, "-", "positive"), ("b", 1, "-", "positive"), ("c", 1, "-", "neutral"), ("d", 1, "-", "-"), ("e", 1, "-", "Positive"))
    got = {r.sentiment: (r.label, r.words, r.percent) for r in sentiment.sentiment_proportions(df).collect()}
    assert got == {
        "positive": ("Positive", 2, "66.67%"),
        "negative": ("Negative", 0, "0.00%"),
        "neutral": ("Neutral", 1, "33.33%"),
    }
    none = sentiment.sentiment_proportions(flat(spark, ("a", 1, "-", "-"))).collect()
    assert [(r.words, r.proportion) for r in none] == [(0, None)] * 3


def test_model_and_table_scorers(spark):
    df = rows_to_table(spark, [("good", 2), ("bad", 1), ("so", 3)], FREQUENCY)

    def load():
        known = {"good": ("positive", 0.9), "bad": ("negative", 0.8)}
        return lambda words: [known.get(w, ("positive", 0.6)) for w in words]

    by_model = sentiment.score_sentiment(df, model_scorer(load))
    assert by_model.columns == ["word", "count", "sentiment", "sentiment_score"]
    assert {r.word: (r.sentiment, r.sentiment_score) for r in by_model.collect()} == {
        "good": ("positive", 0.9), "bad": ("negative", 0.8), "so": ("neutral", 0.5),
    }


def test_word_sentiment(spark):
    df = flat(spark, ("a", 1, "-", "positive"))
    found, unknown = sentiment.word_sentiment(df, ["a", "q"])
    assert {r.word: (r.found, r.sentiment, r.sentiment_scores) for r in found.collect()} == {
        "a": (True, "positive", "0.5"), "q": (False, "N/A", "N/A"),
    }
    assert [r.word for r in unknown.collect()] == ["q"]


def test_pos(spark):
    df = nodes(spark, ("a", "noun"), ("b", "noun"), ("c", None), ("d", "verb"), ("e", "-"))
    got = {r.pos: (r["count"], r.percent) for r in stats.pos_distribution(df).collect()}
    assert got == {"noun": (2, "40.00%"), "UNKNOWN": (1, "20.00%"), "verb": (1, "20.00%"), "-": (1, "20.00%")}
    assert tuple(stats.general_counts(df).first()) == (5, 4)
    assert stats.word_total(df).first()[0] == 5 and stats.pos_total(df).first()[0] == 4
    assert [r.pos for r in stats.sorted_pos(df).collect()] == ["noun", "-", "UNKNOWN", "verb"]
    assert [r.pos for r in stats.sorted_pos(df, "asc", 2).collect()] == ["-", "UNKNOWN"]
    empty = nodes(spark)
    assert tuple(stats.general_counts(empty).first()) == (0, 0)
    assert stats.pos_distribution(empty).count() == 0


@pytest.mark.parametrize("order, limit", [("up", None), ("asc", 0), ("asc", -1), ("asc", "2"), ("asc", True)])
def test_pos_arguments(spark, order, limit):
    with pytest.raises(ValueError):
        stats.sorted_pos(nodes(spark), order, limit)


def test_pos_segments_skip_blank_only(spark):
    df = flat(spark, ("a", 5, "noun", "-"), ("b", 7, "", "-"), ("c", 1, "-", "-"))
    assert {tuple(r) for r in stats.pos_segments(df).collect()} == {("noun", 1), ("-", 1)}


def mirror(spark, *words):
    return lookups.mirror_of(nodes(spark, *((w, "m") for w in words)))


def test_coverage_counts_repeats(spark):
    graph = nodes(spark, ("a", None))
    row = stats.coverage(["a", "a", "q"], mirror(spark), graph).first()
    assert (row.asked, row.found, row.percent) == (3, 2, "66.67%")
    report = {r.word: (r.occurrences, r.found) for r in stats.coverage_report(["a", "a", "q"], mirror(spark), graph).collect()}
    assert report == {"a": (2, True), "q": (1, False)}
    assert tuple(stats.coverage([], mirror(spark), graph).first())[:3] == (0, 0, None)


def test_existence_in_either_store(spark):
    got = lookups.word_existence(["a", "b", "c", "A"], mirror(spark, "b", "c"), nodes(spark, ("a", None), ("c", None)))
    assert {r.word: (r.in_mirror, r.in_graph, r.found) for r in got.collect()} == {
        "a": (False, True, True), "b": (True, False, True), "c": (True, True, True), "A": (False, False, False),
    }


def test_sizes(spark):
    other = rows_to_table(spark, [("word:x", "{}")], MIRROR)
    both = mirror(spark, "b", "c").unionByName(other)
    row = stats.lexicon_size(both, nodes(spark, ("a", None), ("c", None))).first()
    assert tuple(row) == (2, 2, 3)
    assert stats.mirrored_total(both).first()[0] == 2
    assert tuple(stats.lexicon_size(rows_to_table(spark, [], MIRROR), nodes(spark)).first()) == (0, 0, 0)
    assert stats.row_total(both).first()[0] == 3
