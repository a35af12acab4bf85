from __future__ import annotations

import json
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordbase.operators import graph_changes, sentiment, sets
from wordbase.operators.records import build_lexicon, shape_records
from wordbase.schemas import COMPLETED, FREQUENCY, NODE, SCORED, rows_to_table
from wordbase.sources import articles, csv, messages, runs, stores

STAMP = runs.run_stamp(datetime(2024, 12, 12, 21, 8, 30))


def test_csv_is_read_by_name_with_declared_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("POS,word,count,extra\nnoun,a,3,x\n,b,bad,y\n")
    df = csv.read_csv(spark, str(tmp_path / "t.csv"), COMPLETED)
    assert dict(df.dtypes) == {"POS": "string", "word": "string", "count": "string", "extra": "string"}
    shaped = shape_records(df)
    assert {r.word: (r["count"], r.pos) for r in shaped.collect()} == {"a": (3, "noun"), "b": (0, None)}
    assert dict(csv.read_csv(spark, str(tmp_path / "t.csv"), FREQUENCY).dtypes)["count"] == "bigint"


def test_line_breaks_and_quotes_in_node_csv(spark, tmp_path):
    rows = [("a", "noun", None, 0.5, 'one\ntwo, "three"'), ("b", None, "x\r\ny", None, "plain")]
    table = rows_to_table(spark, rows, NODE).withColumnRenamed("name", "word")
    csv.write_csv(table.repartition(3), str(tmp_path / "n"))
    made = csv.read_node_csv(spark, str(tmp_path / "n"), multi_line=True)
    assert sorted((r.name, r.meaning) for r in made.collect()) == [("a", 'one\ntwo, "three"'), ("b", "plain")]
    assert {r.name: r.sentiment.split() for r in made.collect()} == {"a": [], "b": ["x", "y"]}


def test_node_csv_first_row_wins_and_blanks_stay(spark, tmp_path):
    lines = ["word,POS,sentiment,sentiment_score,meaning", "a,noun,positive,0.9,one", "a,verb,,0.1,two", "b,,,,", "c,x,y,bad,z"]
    (tmp_path / "n.csv").write_text("\n".join(lines) + "\n")
    rows = csv.read_node_csv(spark, str(tmp_path / "n.csv"))
    assert rows.filter("bad_score").count() == 1
    made = graph_changes.create_nodes(rows_to_table(spark, [], NODE), rows)
    assert {r.name: tuple(r)[1:] for r in made.collect()} == {
        "a": ("noun", "positive", 0.9, "one"),
        "b": ("", "", None, ""),
        "c": ("x", "y", None, "z"),
    }


def test_node_csv_order_holds_over_file_splits(spark, tmp_path):
    lines = ["word,POS,sentiment,sentiment_score,meaning"]
    lines += [f"w{i % 50},p{i},s,0.5,m" for i in range(20_000)]
    (tmp_path / "n.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = csv.read_node_csv(spark, str(tmp_path / "n.csv"))
        made = graph_changes.create_nodes(rows_to_table(spark, [], NODE), rows).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r.name: r.POS for r in made} == {f"w{i}": f"p{i}" for i in range(50)}


def test_runs(spark, tmp_path):
    root = str(tmp_path)
    for owner, count in (("me", 1), ("you", 2)):
        table = rows_to_table(spark, [("a", count)], FREQUENCY)
        runs.write_run(table, root, runs.CLEANED, STAMP, owner)
    assert STAMP == "12.12.2024_21.08.30"
    back = runs.read_run(spark, root, runs.CLEANED, STAMP, "you", FREQUENCY)
    assert [tuple(r) for r in back.collect()] == [("a", 2)]
    area = runs.read_area(spark, root, runs.CLEANED, FREQUENCY)
    mine = area.filter(F.col("owner") == "me")
    assert [tuple(r) for r in mine.collect()] == [("a", 1, STAMP, "me")]
    assert "PartitionFilters: [isnotnull(owner" in mine._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        runs.run_path(root, "elsewhere", STAMP, "me")
    with pytest.raises(ValueError):
        runs.run_path(root, runs.CLEANED, STAMP, "../me")


def test_annotation_goes_from_area_to_area(spark, tmp_path):
    root = str(tmp_path)
    table = rows_to_table(spark, [("a", 4), ("b", 2), ("c", 1)], FREQUENCY)
    scorer = spark.createDataFrame([("a", "positive", 0.9), ("b", "negative", 0.6)], "word string, label string, score double")
    for area, out in ((runs.CLEANED, runs.LABELLED_CLEANED), (runs.UPDATE, runs.LABELLED_UPDATE)):
        runs.write_run(table, root, area, STAMP, "me")
        sentiment.annotate_run(spark, root, area, STAMP, "me", scorer)
        back = runs.read_run(spark, root, out, STAMP, "me", SCORED)
        assert sorted(tuple(r) for r in back.collect()) == [
            ("a", 4, "positive", 0.9), ("b", 2, "neutral", 0.5), ("c", 1, "-", 0.0),
        ]
    with pytest.raises(ValueError):
        sentiment.annotate_run(spark, root, runs.LABELLED_UPDATE, STAMP, "me", scorer)


def test_update_loop(spark, tmp_path):
    root = str(tmp_path)
    records = shape_records(rows_to_table(spark, [("a", 4)], FREQUENCY), seq=1)
    batch = rows_to_table(spark, [("a", 1), ("b", 7), ("c", 1)], FREQUENCY)
    sets.export_new_words(batch, build_lexicon(records), root, datetime(2024, 12, 12, 21, 8, 30), "me")
    out = runs.read_run(spark, root, runs.UPDATE, STAMP, "me", FREQUENCY)
    assert sorted(tuple(r) for r in out.collect()) == [("b", 1), ("c", 1)]
    once, lexicon = sets.import_update(spark, records, root, 2, STAMP, "me", seq=2)
    twice, again = sets.import_update(spark, once, root, 2, STAMP, "me", seq=3)
    assert (once.count(), twice.count()) == (3, 5)
    assert sorted(lexicon.collect()) == sorted(again.collect())
    with pytest.raises(ValueError):
        sets.import_update(spark, records, root, 3, STAMP, "me", seq=2)


def test_category_titles(spark):
    df = spark.createDataFrame(
        [("x", f"t{i:02}") for i in range(30)] + [("y", "only")], "category string, title string"
    )
    assert [r.title for r in articles.category_titles(df, 3, "x").collect()] == ["t00", "t01", "t02"]
    assert articles.category_titles(df, 3, "none").count() == 0
    every = articles.category_titles(df, 2)
    assert sorted(tuple(r) for r in every.collect()) == [("x", "t00"), ("x", "t01"), ("y", "only")]


def test_article_texts(spark):
    titles = spark.createDataFrame([("a",), ("b",), ("b",), ("none",)], "title string")
    pages = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "second"), ("a", 3, "third"), ("b", 1, "bee"), ("z", 1, "zed")],
        "title string, page int, text string",
    )
    got = articles.article_texts(titles, pages).collect()
    assert sorted((r.title, r.text) for r in got) == [
        ("a", "second"), ("b", "bee"), ("b", "bee"), ("none", ""),
    ]
    titles = titles.selectExpr("if(title = 'a', 'x', 'y') as category", "title")
    pages = pages.selectExpr("'x' as category", "*")
    got = articles.article_texts(titles, pages).collect()
    assert sorted((r.title, r.text) for r in got) == [("a", "second"), ("b", ""), ("b", ""), ("none", "")]


def test_categories_prune_the_articles(spark, tmp_path):
    rows = [("x", "a", "one"), ("y", "a", "two"), ("z", "b", "three")]
    spark.createDataFrame(rows, "category string, title string, text string").write.partitionBy("category").parquet(str(tmp_path / "a"))
    pages = spark.read.parquet(str(tmp_path / "a"))
    titles = spark.createDataFrame([("y", "a"), (None, "b")], "category string, title string")
    narrowed = articles.of_categories(pages, titles)
    found = articles.found_texts(titles, narrowed, unique=True)
    assert [tuple(r) for r in found.collect()] == [("y", "a", "two")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*category#\d+ IN \(y\)|PartitionFilters: \[.*category#\d+ = y", plan), plan


def test_messages_split_large_categories_and_lose_nothing(spark):
    titles = spark.createDataFrame(
        [("big", f"t{i}") for i in range(5000)] + [("small", "s")], "category string, title string"
    )
    sent = messages.title_messages(titles, titles_per_message=500)
    big = sent.filter("category = 'big'").collect()
    sizes = [len(json.loads(r.value)) for r in big]
    assert len(sizes) == 10 and sum(sizes) == 5000 and max(sizes) < 700
    assert sorted((r.part, r.parts) for r in big) == [(i, 10) for i in range(10)]
    again = spark.createDataFrame([("x", "same")] * 2000 + [("x", "other")], "category string, title string")
    sizes = [len(json.loads(r.value)) for r in messages.title_messages(again, 500).collect()]
    assert sum(sizes) == 2001 and max(sizes) <= 500
    back, rejects = messages.decode_titles(sent, "category")
    assert sorted(back.select("category", "title").collect()) == sorted(titles.collect())
    assert rejects.count() == 0


def test_bad_messages_are_rejected(spark):
    sent = spark.createDataFrame([("1", "{oops"), ("2", "[]"), ("3", '["1"]')], "message_id string, value string")
    titles, rejects = messages.decode_titles(sent, "message_id")
    assert [tuple(r) for r in titles.collect()] == [("3", "1")]
    assert [(r.message_id, r.value) for r in rejects.collect()] == [("1", "{oops")]


def test_graph_round_trip(spark, tmp_path):
    nodes = rows_to_table(spark, [("a", None, "s", None, "m"), ("b", "noun", None, 0.5, None)], NODE)
    edges = spark.createDataFrame([("a", "SYNONYM_OF", "b"), ("a", "MERONYM_OF", "b")], "src string, rel string, dst string")
    stores.save_graph(nodes, edges, str(tmp_path / "g"))
    back_nodes, back_edges = stores.load_graph(spark, str(tmp_path / "g"))
    assert sorted(map(str, back_nodes.collect())) == sorted(map(str, nodes.collect()))
    assert sorted(back_edges.collect()) == sorted(edges.collect())


def test_keyed_scan(spark):
    flat = build_lexicon(shape_records(rows_to_table(spark, [("ab", 1), ("b", 2)], FREQUENCY), seq=1))
    assert len(stores.keyed_scan(flat).columns) == 11
    assert [r.key for r in stores.keyed_scan(flat, "word:?").collect()] == ["word:b"]


def test_bad_records_are_set_aside(spark, tmp_path):
    """Every record is a row or a reject with its place, quoted fields and blank ones included."""
    (tmp_path / "in").mkdir()
    lines = ["word,count,score", "a,1,0.5", '"b, ""c""",2,', "d,x,0.1", "e,3", "f,4,0.2,more", "g,,bad", ",,", "h,5,1e3"]
    (tmp_path / "in" / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "in" / "two.csv").write_text("word,count,score\ni,6,nan\nj,7.5,1\n")
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("count", T.LongType()), T.StructField("score", T.DoubleType())])
    good, rejects = csv.read_csv_checked(spark, str(tmp_path / "in"), schema)
    assert sorted(map(str, good.select("word", "count").collect())) == sorted(
        map(str, spark.createDataFrame([("a", 1), ('b, "c"', 2), (None, None), ("h", 5), ("i", 6)], "word string, count long").collect())
    )
    got = {(r["file"].rsplit("/", 1)[1], r["record"], r["reason"]) for r in rejects.collect()}
    assert got == {
        ("one.csv", "d,x,0.1", "count is no bigint"), ("one.csv", "e,3", "wrong number of fields"), ("one.csv", "f,4,0.2,more", "wrong number of fields"),
        ("one.csv", "g,,bad", "score is no double"), ("two.csv", "j,7.5,1", "count is no bigint"),
    }
    places = [(r["file"], r["block"], r["row"]) for r in rejects.collect()]
    assert len(set(places)) == len(places)
    assert good.select("word").count() == 5 and rejects.select("reason").count() == 5  # whichever columns are asked for
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("word,count,score\n")
    assert [df.count() for df in csv.read_csv_checked(spark, str(tmp_path / "none"), schema)] == [0, 0]


@pytest.mark.parametrize("block", [64, 200, 1000, 1 << 20])
def test_a_long_file_is_read_by_many_tasks(spark, tmp_path, settings, block):
    """Records over several lines, over the borders of blocks and over whole blocks, as one task would read them."""
    rng = random.Random(block)
    fields = ["plain", "", "a, b", 'say "x"', "two\nlines", '"', '""\n"', "long " * 60, "\n" * 5, "été\n中"]
    (tmp_path / "in").mkdir()
    for name in ("one", "two"):
        rows = [(f"w{i}", str(i), *(rng.choice(fields) for _ in range(2))) for i in range(150)]
        lines = [",".join(f'"{x.replace(chr(34), chr(34) * 2)}"' if rng.random() < 0.7 or re.search('[,"\n\r]', x) else x for x in row) for row in rows]
        end = "\r\n" if name == "two" else "\n"
        (tmp_path / "in" / f"{name}.csv").write_text(end.join(["word,count,a,b", *lines[:70], "", *lines[70:]]) + end, newline="")
    settings(files__maxPartitionBytes=str(block), files__openCostInBytes="0")
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])
    got = csv.read_long_csv(spark, str(tmp_path / "in"), schema)
    want = csv.read_csv(spark, str(tmp_path / "in"), schema, multi_line=True)
    assert got.dtypes == want.dtypes and want.count() == 300
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    lines = spark.read.text(str(tmp_path / "in"))
    assert lines.rdd.getNumPartitions() > 20 or block >= 1000


def test_long_files_without_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("word,count\n")
    assert csv.read_long_csv(spark, str(tmp_path / "t.csv"), FREQUENCY).count() == 0
    (tmp_path / "u.csv").write_text('"a\r\nb",1\n\nc,bad', newline="")
    got = csv.read_long_csv(spark, str(tmp_path / "u.csv"), FREQUENCY, header=False)
    assert sorted(map(tuple, got.collect())) == [("a\r\nb", 1), ("c", None)]  # line breaks in quotes stay as they are
