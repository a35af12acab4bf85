from __future__ import annotations

import itertools
import json
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from wordbase.operators import graph_changes, lookups, network
from wordbase.schemas import EDGE, MIRROR, NODE, rows_to_table


@pytest.fixture()
def nodes(spark):
    rows = [("a", "noun", "positive", 0.9, "ma"), ("b", None, None, None, None), ("c", "verb", "neutral", 0.5, "mc")]
    return rows_to_table(spark, rows, NODE)


@pytest.fixture()
def edges(spark):
    rows = [("a", "SYNONYM_OF", "b"), ("a", "HYPERNYM_OF", "b"), ("b", "SYNONYM_OF", "a"), ("c", "SYNONYM_OF", "c"), ("c", "MERONYM_OF", "a")]
    return rows_to_table(spark, rows, EDGE)


def by_name(df):
    return {r.name: tuple(r)[1:] for r in df.collect()}


def triples(df):
    return sorted(tuple(r) for r in df.collect())


def test_mirror_keeps_all_fields_and_other_keys(spark, nodes):
    old = rows_to_table(spark, [("lexicon:a", "{}"), ("lexicon:z", "{}"), ("word:a", "x")], MIRROR)
    got = {r.key: r.value for r in lookups.refresh_mirror(old, nodes).collect()}
    assert set(got) == {"lexicon:a", "lexicon:b", "lexicon:c", "lexicon:z", "word:a"}
    assert json.loads(got["lexicon:b"]) == {"name": "b", "POS": None, "sentiment": None, "sentiment_score": None, "meaning": None}
    nameless = nodes.unionByName(rows_to_table(spark, [(None, None, None, None, None), ("", None, None, None, None)], NODE))
    assert tuple(lookups.refresh_report(nameless).first()) == (5, 3)
    assert lookups.mirror_of(nameless).count() == 3


def test_read_through_prefers_the_mirror_and_fills_it(spark, nodes):
    mirror = lookups.mirror_of(rows_to_table(spark, [("a", "other", None, None, "cached")], NODE))
    answer, added = lookups.read_through(["a", "c", "q"], mirror, nodes)
    got = {r.name: (r.source, r.POS, r.meaning) for r in answer.collect()}
    assert got == {"a": ("mirror", "other", "cached"), "c": ("graph", "verb", "mc"), "q": (None, None, None)}
    assert [r.key for r in added.collect()] == ["lexicon:c"]


def test_store_comparison(spark, nodes):
    mirror = lookups.mirror_of(nodes.filter("name <> 'c'")).unionByName(
        lookups.mirror_of(rows_to_table(spark, [("c", "other", None, None, None)], NODE))
    )
    got = {r.word: r for r in lookups.compare_stores(["a", "b", "c", "q"], mirror, nodes).collect()}
    assert {w: r.agree for w, r in got.items()} == {"a": True, "b": True, "c": False, "q": True}
    assert got["a"].graph_data.definition == "ma" and got["q"].mirror_data is None
    with pytest.raises(ValueError):
        lookups.compare_stores("a", mirror, nodes)


def test_neighbours_are_outgoing_and_need_a_node(spark, nodes, edges):
    dangling = edges.unionByName(rows_to_table(spark, [("a", "SYNONYM_OF", "nowhere")], EDGE))
    got = lookups.neighbours(dangling, nodes, ["a"]).collect()
    assert sorted((r.relationship, r.related.name) for r in got) == [("HYPERNYM_OF", "b"), ("SYNONYM_OF", "b")]
    assert lookups.neighbours(dangling, nodes).count() == 5


def test_create_nodes(spark, nodes):
    new = spark.createDataFrame(
        [("a", "x", "", 0.1, "", 1), ("d", "x", "", 0.1, "one", 2), ("d", "y", "", 0.2, "two", 1), ("e", "z", "", None, "", 1)],
        "name string, POS string, sentiment string, sentiment_score double, meaning string, seq int",
    )
    got = by_name(graph_changes.create_nodes(nodes, new))
    assert got["a"][0] == "noun" and got["d"][3] == "two" and len(got) == 5
    mirror = lookups.mirror_of(rows_to_table(spark, [("e", None, None, None, None)], NODE))
    assert "e" not in by_name(graph_changes.create_nodes(nodes, new, mirror))


def test_merge_pairs(spark, nodes, edges):
    pairs = spark.createDataFrame(
        [
            (1, "a", ("p1", None), "d", ("p2", "md"), " synonym"),
            (2, "d", (None, "later"), "a", ("p3", None), "HOLONYM_OF"),
            (3, "x", ("p", "m"), "y", ("p", "m"), "friend"),
            (4, "a", (None, None), "b", (None, None), "SYNONYM_OF"),
        ],
        """seq int, word1 string, properties1 struct<POS:string,meaning:string>, word2 string,
        properties2 struct<POS:string,meaning:string>, relationship string""",
    )
    merged = graph_changes.merge_pairs(nodes, edges, pairs)
    got = by_name(merged.nodes)
    assert got == {
        "a": ("p3", "positive", 0.9, "ma"),
        "b": (None, None, None, None),
        "c": ("verb", "neutral", 0.5, "mc"),
        "d": ("p2", None, None, "later"),
    }
    assert set(triples(merged.edges)) - set(triples(edges)) == {("a", "SYNONYM_OF", "d"), ("d", "HOLONYM_OF", "a")}
    assert merged.edges.count() == edges.count() + 2
    assert [r.word1 for r in merged.rejects.collect()] == ["x"]


def test_patches_skip_blanks(spark, nodes):
    patch = spark.createDataFrame(
        [("a", " ", "negative", "bad", "", 1), ("c", "adj", None, "0.25", "x", 1), ("c", "", None, "", "y", 2), ("q", "noun", None, None, None, 1)],
        "name string, POS string, sentiment string, sentiment_score string, meaning string, seq int",
    )
    result = graph_changes.patch_nodes(nodes, patch)
    got = by_name(result.nodes)
    assert got["a"] == ("noun", "negative", 0.9, "ma") and got["c"] == ("adj", "neutral", 0.25, "y")
    assert len(got) == 3 and [tuple(r) for r in result.rejects.collect()] == [("q", "unknown word")]


def test_set_relations_replaces_all_of_the_pair(spark, nodes, edges):
    patch = spark.createDataFrame(
        [("a", "b", "antonym", 1), ("a", "b", "meronym", 2), ("a", "q", "synonym", 1), ("q", "a", "synonym", 1), ("a", "c", "odd", 1)],
        "src string, dst string, rel string, seq int",
    )
    result = graph_changes.set_relations(nodes, edges, patch)
    assert triples(result.edges) == sorted(
        [("a", "MERONYM_OF", "b"), ("b", "SYNONYM_OF", "a"), ("c", "SYNONYM_OF", "c"), ("c", "MERONYM_OF", "a")]
    )
    assert triples(result.rejects) == [
        ("a", "c", "unknown relation"), ("a", "q", "unknown related word"), ("q", "a", "unknown word"),
    ]


def test_delete_needs_confirmation_and_detaches(spark, nodes, edges):
    requests = spark.createDataFrame([("a", " a "), ("a", "a"), ("b", "no"), ("q", "q"), ("c", None)], "name string, confirm string")
    result = graph_changes.delete_nodes(nodes, edges, requests)
    assert set(by_name(result.nodes)) == {"b", "c"}
    assert triples(result.edges) == [("c", "SYNONYM_OF", "c")]
    assert triples(result.rejects) == [("b", "not confirmed"), ("c", "not confirmed"), ("q", "unknown word")]
    left = graph_changes.drop_mirrored(lookups.mirror_of(nodes), nodes.filter("name = 'a'"))
    assert sorted(r.key for r in left.collect()) == ["lexicon:b", "lexicon:c"]


def test_delete_keys(spark):
    mirror = rows_to_table(spark, [("lexicon:a", "1"), ("lexicon:ab", "2"), ("word:a", "3")], MIRROR)
    for pattern, kept in (("*", []), ("lexicon:?", ["lexicon:ab", "word:a"]), ("word:*", ["lexicon:a", "lexicon:ab"]), ("x", ["lexicon:a", "lexicon:ab", "word:a"])):
        left, report = graph_changes.delete_keys(mirror, pattern)
        assert sorted(r.key for r in left.collect()) == kept
        assert report.first().deleted == 3 - len(kept)


def test_simple_graph(spark):
    rows = [("a", "SYNONYM_OF", "b"), ("b", "SYNONYM_OF", "a"), ("c", "SYNONYM_OF", "c"), ("d", "SYNONYM_OF", "c"), ("x", "MERONYM_OF", "y")]
    edges = rows_to_table(spark, rows, EDGE)
    graph = network.undirected(network.relation_edges(edges, "synonym"))
    assert triples(graph) == [("a", "b"), ("c", "c"), ("c", "d")]
    assert {r.node: r.degree for r in network.degrees(graph).collect()} == {"a": 1, "b": 1, "c": 3, "d": 1}
    assert tuple(network.graph_summary(edges, "Synonym").first()) == ("SYNONYM_OF", 4, 3)
    assert tuple(network.graph_summary(edges, "antonym").first()) == ("ANTONYM_OF", 0, 0)
    with pytest.raises(ValueError):
        network.relation_edges(edges, "friend")


def test_related_words_are_whole_lists_of_the_first_words(spark):
    rows = [(f"w{i}", "SYNONYM_OF", f"r{j}") for i in range(9) for j in range(i + 1)]
    got = network.related_words(rows_to_table(spark, rows, EDGE), "synonym", 5).collect()
    assert sorted((r.word, r.related) for r in got) == sorted((w, r) for w, _, r in rows if w < "w5")


def cost(values, bounds):
    total, groups = 0.0, [[] for _ in range(len(bounds) + 1)]
    for v in values:
        groups[sum(v > b for b in bounds)].append(v)
    for g in groups:
        if g:
            m = sum(g) / len(g)
            total += sum((v - m) ** 2 for v in g)
    return total


def test_clusters_are_ordered_stable_and_optimal(spark):
    degree_of = {f"n{i:03}": d for i, d in enumerate([1] * 60 + [2] * 25 + [7] * 4 + [8] * 3 + [30, 31, 40])}
    df = spark.createDataFrame(list(degree_of.items()), "node string, degree long")
    clusters = {r.node: r.cluster for r in network.degree_clusters(df).collect()}
    again = {r.node: r.cluster for r in network.degree_clusters(df.repartition(5)).collect()}
    assert clusters == again and set(clusters.values()) == {0, 1, 2}
    ordered = sorted(degree_of, key=degree_of.get)
    assert [clusters[n] for n in ordered] == sorted(clusters.values())
    values = list(degree_of.values())
    best = min(cost(values, cut) for cut in itertools.combinations(sorted(set(values)), 2))
    bounds = [max(degree_of[n] for n in clusters if clusters[n] == c) for c in (0, 1)]
    assert math.isclose(cost(values, bounds), best)
    assert [r.node for r in network.first_nodes(network.degree_clusters(df)).collect()] == [f"n{i:03}" for i in range(5)]


def test_ranges_are_the_best(spark):
    rng = random.Random(5)
    for _ in range(40):
        histogram = sorted({rng.randint(1, 60): rng.randint(1, 9) for _ in range(rng.randint(4, 14))}.items())
        values = [v for v, n in histogram for _ in range(n)]
        for k in (1, 2, 3, 4):
            ends = network.best_ranges(histogram, k)
            assert len(ends) == k and ends[-1] == histogram[-1][0]
            best = min(cost(values, cut) for cut in itertools.combinations([v for v, _ in histogram[:-1]], k - 1))
            assert math.isclose(cost(values, ends[:-1]), best, abs_tol=1e-6)
    assert network.best_ranges([], 3) == [] and network.best_ranges([(2, 5)], 3) == [2]


def test_fewer_degrees_than_clusters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "node string, degree long")
    assert {r.node: r.cluster for r in network.degree_clusters(df).collect()} == {"a": 0, "b": 0, "c": 1}


def test_confirmed_words_leave_all_three_tables(spark):
    nodes = rows_to_table(spark, [(n, None, None, None, None) for n in "abc"], NODE)
    edges = rows_to_table(spark, [("a", "SYNONYM_OF", "b"), ("b", "SYNONYM_OF", "c"), ("c", "SYNONYM_OF", "a")], EDGE)
    mirror = spark.createDataFrame([(f"lexicon:{n}", "{}") for n in "abcd"], "key string, value string")
    asked = spark.createDataFrame([("a", "\ta \n"), ("b", "no"), ("d", "d")], "name string, confirm string")
    done = graph_changes.delete_nodes(nodes, edges, asked, mirror)
    assert sorted(r.name for r in done.nodes.collect()) == ["b", "c"]
    assert [tuple(r) for r in done.edges.collect()] == [("b", "SYNONYM_OF", "c")]
    assert sorted(r.key for r in done.mirror.collect()) == ["lexicon:b", "lexicon:c", "lexicon:d"]
    assert sorted(tuple(r) for r in done.rejects.collect()) == [("b", "not confirmed"), ("d", "unknown word")]


def clusters_of(spark, degrees, k=3):
    table = spark.createDataFrame(list(enumerate(degrees)), "node long, degree long")
    rows = network.degree_clusters(table, k).collect()
    assert len(rows) == len(degrees)
    return {r["degree"]: r["cluster"] for r in rows}


def spread_of(degrees, clusters):
    """Squared distance of all degrees to the means of their clusters."""
    total = 0.0
    for c in set(clusters.values()):
        own = [d for d in degrees if clusters[d] == c]
        mean = sum(own) / len(own)
        total += sum((d - mean) ** 2 for d in own)
    return total


def test_more_degrees_than_are_told_apart(spark, monkeypatch):
    """In bins, clusters are still ranges, cost hardly more than the best ones, and their borders are off by the stated factor at most."""
    rng = random.Random(4)
    degrees = [int(rng.paretovariate(0.8) * 10) for _ in range(3000)]
    exact = clusters_of(spark, degrees)
    monkeypatch.setattr(network, "EXACT_DEGREES", 50)
    binned = clusters_of(spark, degrees)
    ordered = [binned[d] for d in sorted(binned)]
    assert ordered == sorted(ordered) and set(ordered) == {0, 1, 2}
    assert spread_of(degrees, exact) <= spread_of(degrees, binned) <= 1.05 * spread_of(degrees, exact)
    monkeypatch.setattr(network, "EXACT_DEGREES", len(set(degrees)))
    assert clusters_of(spark, degrees) == exact


def test_very_many_degrees_take_bounded_time(spark):
    table = spark.range(1, 60_001).select(F.col("id").alias("node"), (F.col("id") * F.col("id") + 10**9).alias("degree"))
    bins = network.degree_bins(table)
    assert len(bins) <= math.log(3.6e9 + 1e9) / math.log1p(network.DEGREE_ERROR) and sum(b.n for b in bins) == 60_000
    assert sum(b.squares for b in bins) == sum((i * i + 10**9) ** 2 for i in range(1, 60_001))  # exact, beyond 64 bits
    begun = time.process_time()
    assert len(network.best_bin_ranges(bins, 3)) == 3 and time.process_time() - begun < 20
