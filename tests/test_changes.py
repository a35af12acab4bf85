from __future__ import annotations

import pytest

from wordbase.operators import changes, lookups, sets
from wordbase.schemas import FLAT, FREQUENCY, rows_to_table

DASHES = ("-", "-", "-", "-")
ENTRY = """word string, meaning string, pos string, sentiment string, sentiment_scores string,
synonyms string, antonyms string, hypernyms string, meronyms string"""


@pytest.fixture()
def lexicon(spark):
    rows = [
        ("a", 4, "first", "noun", "positive", 0.9, *DASHES),
        ("b", 2, "second", "verb", "negative", 0.8, *DASHES),
    ]
    return rows_to_table(spark, rows, FLAT)


def entries(spark, *rows):
    full = [(w, "new", "adj", "neutral", score, *DASHES) for w, score in rows]
    return spark.createDataFrame(full, ENTRY)


def by_word(df):
    return {r.word: r for r in df.collect()}


def test_insert_checks_no_key(spark, lexicon):
    got = changes.insert_records(lexicon, spark.createDataFrame([("a", "x")], "word string, meaning string"))
    assert sorted((r.word, r["count"], r.meaning) for r in got.collect()) == [("a", 0, "x"), ("a", 4, "first"), ("b", 2, "second")]


def test_upsert_replaces_the_whole_row_and_the_last_patch_counts(spark, lexicon):
    patch = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("c", "third", 1)], "word string, meaning string, seq int")
    got = by_word(changes.upsert(lexicon, patch))
    assert tuple(got["a"]) == ("a", 0, "new", "-", "-", 0.0, *DASHES)
    assert got["c"].meaning == "third" and got["b"].meaning == "second" and len(got) == 3


def test_insert_absent_leaves_known_words(spark, lexicon):
    got = by_word(changes.insert_absent(lexicon, spark.createDataFrame([("a", "x"), ("c", "y")], "word string, meaning string")))
    assert (got["a"].meaning, got["c"].meaning) == ("first", "y")


def test_manual_entry(spark, lexicon):
    result = changes.enter_new(lexicon, entries(spark, ("a", "0.7"), ("c", "0.7"), ("d", "bad")))
    got = by_word(result.lexicon)
    assert (got["c"]["count"], got["c"].sentiment_scores, got["a"].meaning) == (1, 0.7, "first")
    assert {tuple(r) for r in result.rejects.collect()} == {("a", "already exists"), ("d", "score is no number")}


def test_manual_update_keeps_the_count(spark, lexicon):
    result = changes.update_fields(lexicon, entries(spark, ("a", "0.7"), ("b", ""), ("c", "1")))
    got = by_word(result.lexicon)
    assert (got["a"]["count"], got["a"].meaning, got["b"].meaning, got["c"]["count"]) == (4, "new", "second", 0)
    assert [r.word for r in result.rejects.collect()] == ["b"]


def test_corrections_are_routed(spark):
    words = ["kept", "kept2", "updated", "declined", "invalid", "invalid2", "badscore"]
    lexicon = rows_to_table(spark, [(w, 5, "old", "-", "-", 0.0, *DASHES) for w in words], FLAT)
    rows = [
        ("kept", "Y", None, "0.5"), ("kept2", "y", "N", "0.5"), ("updated", "n", "y", "0.5"),
        ("declined", "N", "n", "0.5"), ("invalid", "maybe", "Y", "0.5"), ("invalid2", "N", "", "0.5"),
        ("badscore", "N", "Y", "much"), ("unknown", "Y", "N", "0.5"), ("unknown2", None, None, "x"),
    ]
    full = [(w, a, p, "new", "adj", "neutral", s, *DASHES) for w, a, p, s in rows]
    schema = "word string, is_correct string, proceed string, " + ENTRY.replace("word string, ", "")
    after, outcomes = changes.correct(lexicon, spark.createDataFrame(full, schema))
    assert {r.word: r.outcome for r in outcomes.collect()} == {
        "kept": "kept", "kept2": "kept", "updated": "updated", "declined": "declined",
        "invalid": "invalid answer", "invalid2": "invalid answer", "badscore": "score is no number",
        "unknown": "inserted", "unknown2": "score is no number",
    }
    got = by_word(after)
    assert {w for w, r in got.items() if r.meaning == "new"} == {"updated", "unknown"}
    assert (got["updated"]["count"], got["unknown"]["count"], len(got)) == (5, 1, 8)


def test_flush(lexicon):
    emptied = changes.flush(lexicon)
    assert emptied.count() == 0 and emptied.schema == lexicon.schema


def test_lookups(spark, lexicon):
    found = by_word(lookups.find_words(lexicon, ["a", "q", "a"]))
    assert (found["a"].found, found["a"].meaning, found["q"].found, len(found)) == (True, "first", False, 2)
    counts = {r.word: r["count"] for r in lookups.stored_counts(lexicon, ["a", "q"]).collect()}
    assert counts == {"a": 4, "q": 0}
    fields = {r.field: r.value for r in lookups.record_fields(lexicon.filter("word = 'a'")).collect()}
    assert (fields["Count"], fields["Sentiment_scores"], fields["Meaning"], len(fields)) == ("4", "0.9", "first", 9)
    with pytest.raises(ValueError):
        lookups.find_words(lexicon, "a")
    text = lookups.record_json(lexicon.filter("word = 'a'"), "word", "count").first()[0]
    assert text == '{"word":"a","count":4}'


def test_new_words_are_distinct_and_nulls_equal(spark, lexicon):
    batch = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "word string")
    assert [r.word for r in sets.new_words(batch, lexicon).orderBy("word").collect()] == [None, "c"]
    known = rows_to_table(spark, [(None, 1)], FREQUENCY)
    assert {r.word for r in sets.new_words(batch, known).collect()} == {"a", "c"}


def test_new_word_counts(spark, lexicon):
    batch = rows_to_table(spark, [("a", 3), ("c", 7)], FREQUENCY)
    assert [tuple(r) for r in sets.new_word_counts(batch, lexicon).collect()] == [("c", 1)]
    assert [tuple(r) for r in sets.new_word_counts(batch, lexicon, "corpus").collect()] == [("c", 7)]
    with pytest.raises(ValueError):
        sets.new_word_counts(batch, lexicon, "other")
