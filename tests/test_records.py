from __future__ import annotations

from wordbase.operators import records
from wordbase.schemas import COMPLETED, FLAT, FREQUENCY

RAW = [("baik", "3"), ("word", "count"), ("x", None), ("y", "12.5"), ("z", "bad"), ("", "1")]


def raw(spark):
    return spark.createDataFrame(RAW, "word string, count string")


def test_shaping_guards_casts_and_defaults(spark):
    shaped = records.shape_records(raw(spark), seq=1)
    rows = {r.word: r for r in shaped.collect()}
    assert {w: r["count"] for w, r in rows.items()} == {"baik": 3, "y": 0, "z": 0, "": 1}
    baik = rows["baik"]
    assert tuple(baik.annotation) == ("-", 0.0, "-", "-", "-", "-")
    assert (baik.meaning, baik.pos, baik.seq) == ("-", "-", 1)


def test_a_null_in_a_present_column_passes_and_is_filled_when_flattened(spark):
    df = spark.createDataFrame([("a", 1, None, None)], "word string, count long, sentiment string, POS string")
    shaped = records.shape_records(df)
    assert shaped.first().annotation.sentiment is None and shaped.first().pos is None
    flat = records.flatten(shaped)
    assert flat.columns == FLAT.names
    assert (flat.first().sentiment, flat.first().pos) == ("-", "-")


def test_blank_words_are_left_out_of_the_flat_table(spark):
    df = spark.createDataFrame([("", 1), (None, 2), ("a", 3)], FREQUENCY)
    assert [r.word for r in records.flatten(records.shape_records(df)).collect()] == ["a"]


def test_the_last_load_of_a_word_wins(spark):
    schema = "word string, count long, POS string"
    first = spark.createDataFrame([("a", 1, "noun"), ("b", 5, "verb")], schema)
    second = spark.createDataFrame([("a", 2, "verb")], schema)
    appended = records.append_records(
        records.shape_records(first, seq=1), records.shape_records(second, seq=2)
    )
    assert appended.count() == 3
    lexicon = {r.word: (r["count"], r.pos) for r in records.build_lexicon(appended).collect()}
    assert lexicon == {"a": (2, "verb"), "b": (5, "verb")}


def test_nesting_is_the_inverse_of_flattening(spark):
    shaped = records.shape_records(raw(spark), seq=1)
    flat = records.flatten(shaped)
    assert sorted(records.flatten(records.nest(flat)).collect()) == sorted(flat.collect())


def test_load_report(spark):
    assert records.load_report(raw(spark)).first().asDict() == {
        "rows": 6, "records": 4, "without_count": 1, "repeated_headers": 1, "without_word": 1,
    }


def test_empty_input(spark):
    shaped = records.shape_records(spark.createDataFrame([], COMPLETED), seq=1)
    assert records.build_lexicon(shaped).count() == 0


def test_nodes_from_lexicon(spark):
    df = spark.createDataFrame([("a", 1, "noun")], "word string, count long, POS string")
    nodes = records.nodes_from_lexicon(records.flatten(records.shape_records(df)))
    assert tuple(nodes.first()) == ("a", "noun", "-", 0.0, "-")
