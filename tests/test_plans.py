"""Checks of physical plans: what is pruned, pushed down, split and never done in Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordbase import runtime
from wordbase.operators import changes, graph_changes, keyed, lookups, network, sentiment, sets, stats
from wordbase.operators.tokens import token_rows, word_counts
from wordbase.plans.queries import QUERIES
from wordbase.schemas import EDGE, FLAT, NODE, rows_to_table
from wordbase.sources import articles, stores

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def saved(spark, tmp_path, schema, rows):
    path = str(tmp_path / "table")
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_counting_reads_one_column_and_shuffles_counts_only(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(word_counts(token_rows(documents)))
    assert "ReadSchema: struct<text:string>" in text
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_no_query_runs_python_but_the_model_scorer(spark):
    for name, query in QUERIES.items():
        if name == "stream_word_count":
            continue  # it runs jobs of its own, out of the same parts
        text = plan(query(spark, SF))
        assert ("ArrowEvalPython" in text) == (name == "sentiment_scored_by_model"), name
        assert "BatchEvalPython" not in text and "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_key_lists_are_broadcast_and_the_lexicon_is_not_shuffled(spark, tmp_path):
    lexicon = saved(spark, tmp_path, FLAT, [(f"w{i}", i, "-", "-", "-", 0.0, "-", "-", "-", "-") for i in range(1000)])
    found = keyed.matching(lexicon, keyed.as_keys(lexicon, ["w1", "w2"]), "word")
    assert "BroadcastHashJoin" in plan(found) and "Exchange hashpartitioning" not in plan(found)


def test_patches_do_not_shuffle_the_lexicon(spark, tmp_path):
    lexicon = saved(spark, tmp_path, FLAT, [(f"w{i}", i, "-", "-", "-", 0.0, "-", "-", "-", "-") for i in range(1000)])
    schema = T.StructType([FLAT["word"], FLAT["meaning"]])
    patch = rows_to_table(spark, [("w1", "x")], schema)
    text = plan(changes.upsert(lexicon, patch))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_short_patches_do_not_shuffle_long_tables(spark, tmp_path):
    nodes = saved(spark, tmp_path / "n", NODE, [(f"w{i}", "x", "-", 0.0, "-") for i in range(2000)])
    edges = saved(spark, tmp_path / "e", EDGE, [(f"w{i}", "SYNONYM_OF", f"w{i + 1}") for i in range(2000)])
    lexicon = saved(spark, tmp_path / "l", FLAT, [(f"w{i}", i, "-", "-", "-", 0.0, "-", "-", "-", "-") for i in range(2000)])
    word = rows_to_table(spark, [("w1", 3)], T.StructType([FLAT["word"], FLAT["count"]]))
    node = rows_to_table(spark, [("w1", "y", None, None, None)], NODE)
    entry = word.selectExpr("word", "'0.5' as sentiment_scores")
    pair = "1 as seq, 'w1' as word1, struct('m' as meaning) as properties1, 'w2' as word2, struct('m' as meaning) as properties2, 'synonym' as relationship"
    merged = graph_changes.merge_pairs(nodes, edges, word.selectExpr(*pair.split(", ")))
    changed = {
        "insert_absent": changes.insert_absent(lexicon, word), "enter_new": changes.enter_new(lexicon, entry).lexicon,
        "refused": changes.enter_new(lexicon, entry).rejects, "create_nodes": graph_changes.create_nodes(nodes, node),
        "mirror": graph_changes.create_nodes(nodes, node, lookups.mirror_of(nodes)), "unknown": sentiment.word_sentiment(lexicon, word)[1],
        "new_words": sets.new_words(word, lexicon), "counts": sets.new_word_counts(word, lexicon, "corpus"), "merged": merged.edges,
    }
    for name, df in changed.items():
        for line in plan(df).splitlines():
            assert "SortMergeJoin" not in line and "ShuffledHashJoin" not in line, name
    assert sorted(tuple(r) for r in merged.edges.collect()) == sorted(tuple(r) for r in edges.collect())


def test_no_text_is_shuffled_to_count_words(spark):
    for name in ("word_count", "token_rows"):
        exchanges = [line for line in plan(QUERIES[name](spark, SF)).splitlines() if "Exchange" in line]
        assert len(exchanges) == (name == "word_count") and not any("text#" in line for line in exchanges)


def test_each_input_is_read_once_or_twice(spark):
    assert plan(QUERIES["titles_text"](spark, SF)).count("ReadSchema: struct<doc_id:bigint,text:string,source:string>") == 1
    assert plan(QUERIES["title_lists"](spark, SF)).count("documents.parquet") == 1  # and once to count the categories
    assert plan(QUERIES["set_relation"](spark, SF)).count("FileScan") < 40


def test_importing_is_a_step_of_its_own(spark):
    """Tasks that import nodes hold neither the words being counted nor those being scored: these are written first."""
    read = QUERIES["node_csv_import"](spark, SF).inputFiles()
    assert read and not any("documents" in path or "conversations" in path for path in read)


def test_large_sides_are_never_forced_into_a_broadcast(spark, settings, tmp_path):
    settings(autoBroadcastJoinThreshold="-1")
    lexicon = saved(spark, tmp_path, FLAT, [(f"w{i}", i, "-", "-", "-", 0.0, "-", "-", "-", "-") for i in range(100)])
    words = lexicon.select("word")
    for df in (lookups.find_words(lexicon, words), changes.upsert(lexicon, lexicon)):
        assert "Broadcast" not in plan(df)


def test_the_median_repeats_no_rows(spark):
    histogram = stats.length_histogram(spark.createDataFrame([("a", None, None, None, None)], NODE))
    assert "Generate" not in plan(stats.length_summary(histogram))


def test_category_limits_are_applied_before_the_shuffle(spark):
    df = spark.createDataFrame([("x", "t")], "category string, title string")
    text = plan(articles.category_titles(df, 3))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "TakeOrderedAndProject" in plan(articles.category_titles(df, 3, "x"))


def test_extremes_are_top_k(spark):
    df = spark.createDataFrame([("a", 1)], "word string, count long")
    assert "TakeOrderedAndProject" in plan(stats.most_common(df))


def test_prefix_patterns_and_relations_reach_the_scan(spark, tmp_path):
    nodes = spark.createDataFrame([("a", None, None, None, None)], NODE)
    edges = spark.createDataFrame([("a", "SYNONYM_OF", "b"), ("a", "MERONYM_OF", "b")], EDGE)
    stores.save_graph(nodes, edges, str(tmp_path / "g"))
    back = stores.load_graph(spark, str(tmp_path / "g"))[1]
    assert "PartitionFilters: [isnotnull(rel" in plan(network.relation_edges(back, "synonym"))
    lookups.mirror_of(nodes).write.parquet(str(tmp_path / "m"))
    mirror = spark.read.parquet(str(tmp_path / "m"))
    assert "StringStartsWith(key,lexicon:)" in plan(lookups.mirror_names(mirror))


@pytest.mark.parametrize("every", [3, 1111])
def test_a_hub_is_split_over_tasks(spark, settings, every):
    """A third or 0.09 % of all relations lead to one word; no task gets much more than its part."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    ids = spark.range(0, 60_000, 1, 16)
    hub = F.when(F.col("id") % every == 0, "hub").otherwise(F.concat(F.lit("n"), F.col("id") % 997))
    edges = ids.select(F.sha2(F.col("id").cast("string"), 256).alias("src"), F.lit("SYNONYM_OF").alias("rel"), hub.alias("dst"))
    names = edges.select(F.col("dst").alias("name")).distinct()
    nodes = names.select("name", *(F.lit(None).cast(NODE[c].dataType).alias(c) for c in NODE.names[1:]))
    found = lookups.neighbours(edges, nodes)
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 60_000 and len(per_task) == 8
    assert max(per_task) < 60_000 / 8 * 1.3


def test_equal_rows_are_split_over_tasks(spark, settings):
    """A third of all titles are the same; they are counted before the join and repeated after it."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    title = F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id")))
    titles = spark.range(0, 60_000, 1, 16).select(title.alias("title"))
    pages = titles.distinct().select("title", F.concat(F.lit("text of "), "title").alias("text"))
    found = articles.found_texts(titles, pages, unique=True)
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 60_000 and max(per_task) < 60_000 / 8 * 1.5
    assert found.filter("title = 'same' AND text = 'text of same'").count() == 20_000


def test_a_short_side_is_broadcast_and_the_long_one_not_shuffled(spark, tmp_path):
    rows = [(f"w{i % 900}", "SYNONYM_OF", f"x{i}") for i in range(3000)]
    edges = saved(spark, tmp_path, EDGE, rows)
    few = rows_to_table(spark, [("w1",)], T.StructType([T.StructField("src", T.StringType())]))
    text = plan(keyed.spread_join(edges, few, "src", "left_anti"))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    titles = few.withColumnRenamed("src", "title")
    pages = edges.selectExpr("src as title", "dst as text")
    text = plan(articles.found_texts(titles, pages, unique=True))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    assert "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("repeats", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joining_in_pieces_changes_no_result(spark, how, repeats):
    left = spark.range(5000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 1500).cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("5", 2), ("7", 3), (None, 4), ("gone", 5)], "k string, v int")
    left = left.select("k") if repeats else left
    got = keyed.spread_join(left, right, "k", how, repeats=repeats)
    want = left.join(right, "k", how)
    assert got.columns == want.columns and keyed.hot_keys(left, ["k"])[0]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    cold = right.filter("k <> 'hot'")
    assert keyed.spread_join(left, cold, "k", how).count() == left.join(cold, "k", how).count()


def test_a_hot_word_is_reduced_before_the_shuffle(spark):
    ids = spark.range(0, 90_000, 1, 6)
    rows = ids.select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("word"),
        F.col("id").alias("seq"),
        F.col("id").cast("string").alias("meaning"),
    )
    last = keyed.one_per_key(rows, "word", "seq")
    assert last.filter("word = 'hot'").first().meaning == "89997"
    assert "partial_max" in plan(last) and plan(last).count("Exchange") == 1


def test_pieces_are_on_several_tasks_where_a_short_side_is_broadcast(spark, settings):
    """A hot key below the broadcast limit: its rows are joined in many tasks, with and without adaptive execution."""
    left = spark.range(0, 1893, 1, 4).select(F.when(F.col("id") % 7 < 4, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("n"))
    right = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") == 5, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.repeat(F.lit("x"), 50).alias("v"))
    right = runtime.stored(right, "right")
    for adaptive in ("true", "false"):
        settings(adaptive__enabled=adaptive, adaptive__coalescePartitions__enabled="true", shuffle__partitions="64", autoBroadcastJoinThreshold="256k")
        joined = keyed.spread_join(runtime.stored(left, "left"), right, "k")
        assert "BuildLeft" in plan(joined) or adaptive == "true"
        hot = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in hot) == left.filter("k = 'hot'").count()
        assert len(hot) >= 16 and max(r["count"] for r in hot) < 1893 / 8


def test_names_of_helpers_do_not_clash(spark):
    left = spark.range(300).select(F.lit("hot").alias("k"), F.col("id").alias("_piece"), F.col("id").alias("_times"), F.col("id").alias("__piece"))
    right = spark.createDataFrame([("hot", 1, 2)], "k string, _part int, _turn int")
    for repeats in (False, True):
        got = keyed.spread_join(left, right, "k", repeats=repeats)
        assert got.columns == ["k", "_piece", "_times", "__piece", "_part", "_turn"]
        assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k").collect()))
