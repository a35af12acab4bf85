"""Tables laid out by key: changes in place, pruned look-ups, and refreshes by difference."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wordbase.functions.parse import mirror_key
from wordbase.operators import changes, differences, graph_changes, lookups
from wordbase.schemas import FLAT, NODE
from wordbase.sources import keyed_tables


def lexicon_of(spark, n):
    word = F.concat(F.lit("w"), F.col("id"))
    plain = spark.range(0, n, 1, 8).select(word.alias("word"), F.col("id").alias("count"), F.concat(F.lit("m"), F.col("id")).alias("meaning"))
    return changes.complete(plain)


def files(path):
    """Every data file with its time of writing."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                whole = os.path.join(folder, name)
                found[whole] = os.stat(whole).st_mtime_ns
    return found


def folders(paths):
    return {int(p.split("/bucket=")[1].split("/")[0]) for p in paths}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def scanned(df):
    """Rows that the scans of a query have read, and the files; the query must not need a shuffle."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i).metrics() for i in range(leaves.size())]
    scans = [m for m in scans if m.contains("numFiles")]
    return sum(m.apply("numOutputRows").value() for m in scans), sum(m.apply("numFiles").value() for m in scans)


@pytest.fixture(scope="module")
def long_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long") / "lexicon")
    return keyed_tables.create(lexicon_of(spark, 1_000_000), path, "word", 512)


def test_a_short_patch_writes_its_folders_only(spark, long_table):
    words = [(f"w{i * 9_973}", 7 * i, "new", 1) for i in range(100)] + [("zzz", 1, "added", 1)]
    patch = spark.createDataFrame(words, "word string, count long, meaning string, seq int")
    before = files(long_table.path)
    want = changes.upsert(keyed_tables.read(spark, long_table), patch).where("meaning IN ('new', 'added')")
    want, total = rows(want), 1_000_001
    outcome = keyed_tables.change(spark, long_table, patch, lambda part: changes.upsert(part, patch))
    assert (outcome.added, outcome.changed, outcome.gone) == (1, 100, 0)
    after = files(long_table.path)
    own = {r[0] for r in patch.select(keyed_tables.bucket_of(F.col("word"), 512)).collect()}
    assert folders(set(before) ^ set(after)) == own == set(outcome.buckets) and len(own) < 120
    assert all(before[f] == after[f] for f in set(before) & set(after))
    table = keyed_tables.read(spark, long_table)
    assert table.count() == total and table.select("word").distinct().count() == total
    assert rows(table.where("meaning IN ('new', 'added')")) == want
    again = keyed_tables.change(spark, long_table, patch, lambda part: changes.upsert(part, patch))
    assert again == keyed_tables.Outcome(0, 0, 0, []) and files(long_table.path) == after


def test_a_short_list_reads_few_rows(spark, long_table):
    found = keyed_tables.look_up(spark, long_table, ["w5", "w77", "nosuchword", None, "w5"])
    assert {r["word"] for r in found.collect()} == {"w5", "w77"}
    read, n_files = scanned(found)
    assert n_files <= 3 and read < 3 * 2_500  # the three folders, of some 2,000 rows each
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(word" in plan


def test_row_groups_are_skipped(spark, tmp_path, monkeypatch):
    """In one folder of many row groups, those whose range of words lacks the key are not read."""
    monkeypatch.setattr(keyed_tables, "ROW_GROUP", 1 << 16)
    table = keyed_tables.create(lexicon_of(spark, 200_000), str(tmp_path / "t"), "word", 1)
    read, n_files = scanned(keyed_tables.look_up(spark, table, ["w123456"]))
    assert n_files == 1 and read < 200_000 / 3
    assert keyed_tables.look_up(spark, table, ["w1234567"]).count() == 0


def test_the_files_have_bloom_filters(spark, tmp_path):
    table = keyed_tables.create(lexicon_of(spark, 300_000), str(tmp_path / "t"), "word", 2)
    for name in files(table.path):
        column = pq.ParquetFile(name).metadata.row_group(0)
        paths = [column.column(i).path_in_schema for i in range(column.num_columns)]
        assert "word" in paths and column.num_rows
    # a word inside the range of every file, that none has: the filter of its one folder answers
    read, _ = scanned(keyed_tables.look_up(spark, table, ["w1x"]))
    assert read < 300_000 / 4


@pytest.mark.parametrize("n", [0, 1, 2000])
def test_look_up_equals_a_filter(spark, long_table, n, monkeypatch):
    """Short lists, and longer ones that are joined, as a list and as a table, repeats and unknown words among them."""
    monkeypatch.setattr(keyed_tables, "SHORT_LIST", 100)
    words = [f"w{i * 13 % 1_000_100}" for i in range(n)] + ["gone", "gone"][:n]
    table = spark.createDataFrame([(w,) for w in words] or [], "word string")
    want = rows(keyed_tables.read(spark, long_table).where(F.col("word").isin(words)))
    assert rows(keyed_tables.look_up(spark, long_table, words)) == want
    assert rows(keyed_tables.look_up(spark, long_table, table)) == want


def nodes_of(spark, names):
    return spark.createDataFrame([(n, "noun", None, 0.5, f"m_{n}") for n in names], NODE)


def test_deletes_empty_folders(spark, tmp_path):
    nodes = nodes_of(spark, "abcdefgh")
    table = keyed_tables.create(nodes, str(tmp_path / "t"), "name", 4)
    requests = spark.createDataFrame([(n, n) for n in "abcdefg"] + [("h", "no"), ("x", "x")], "name string, confirm string")
    edges = spark.createDataFrame([], "src string, rel string, dst string")
    delete = lambda part: graph_changes.delete_nodes(part, edges, requests).nodes
    outcome = keyed_tables.change(spark, table, requests, delete)
    assert (outcome.added, outcome.changed, outcome.gone) == (0, 0, 7)
    assert rows(keyed_tables.read(spark, table)) == rows(nodes.where("name = 'h'"))
    assert len(folders(files(table.path))) == 1
    assert keyed_tables.change(spark, table, requests, delete).buckets == []
    last = keyed_tables.change(spark, table, spark.createDataFrame([("h",)], "name string"), lambda part: part.where("false"))
    assert last.gone == 1 and keyed_tables.read(spark, table).count() == 0
    refill = keyed_tables.change(spark, table, nodes, lambda part: graph_changes.create_nodes(part, nodes))
    assert refill.added == 8 and rows(keyed_tables.read(spark, table)) == rows(nodes)


def test_nulls_and_empty_tables(spark, tmp_path):
    nodes = spark.createDataFrame([("a", None, None, None, None), (None, "noun", None, 0.5, "m"), ("", "x", None, 0.1, "m")], NODE)
    table = keyed_tables.create(nodes, str(tmp_path / "t"), "name", 8)
    assert rows(keyed_tables.read(spark, table)) == rows(nodes.where("name IS NOT NULL"))
    assert keyed_tables.look_up(spark, table, [""]).count() == 1 and keyed_tables.look_up(spark, table, [None]).count() == 0
    patch = spark.createDataFrame([("a", "verb", "", "", ""), (None, "x", "", "", "")], "name string, POS string, sentiment string, sentiment_score string, meaning string")
    outcome = keyed_tables.change(spark, table, patch, lambda part: graph_changes.patch_nodes(part, patch).nodes)
    assert (outcome.added, outcome.changed) == (0, 1)
    none = keyed_tables.create(nodes.where("false"), str(tmp_path / "none"), "name", 8)
    assert keyed_tables.read(spark, none).count() == 0 and keyed_tables.look_up(spark, none, ["a"]).count() == 0
    assert keyed_tables.change(spark, none, nodes.where("false"), lambda part: part).buckets == []
    assert keyed_tables.change(spark, none, nodes, lambda part: nodes.where("name = 'a'")).added == 1
    with pytest.raises(ValueError):
        keyed_tables.create(nodes.withColumn("bucket", F.lit(1)), str(tmp_path / "bad"), "name", 8)


def test_a_change_of_other_keys_is_refused(spark, tmp_path):
    nodes = nodes_of(spark, [f"n{i}" for i in range(50)])
    table = keyed_tables.create(nodes, str(tmp_path / "t"), "name", 16)
    before = files(table.path)
    with pytest.raises(Exception, match="a key of another folder"):
        keyed_tables.change(spark, table, nodes.where("name = 'n1'"), lambda part: part.unionByName(nodes.withColumn("POS", F.lit("x"))))
    assert files(table.path) == before


# --- refreshes by difference ---------------------------------------------


def test_difference(spark):
    before = spark.createDataFrame([("a", 1, None), ("b", None, "x"), ("c", 3, "y"), ("d", 4, "z"), (None, 9, "q")], "k string, n long, t string")
    after = spark.createDataFrame([("a", None, "1"), ("b", None, "x"), ("c", 3, "y!"), ("e", None, None), (None, 8, "p")], "k string, n long, t string")
    changed = differences.difference(differences.state_of(before, "k"), after, "k")
    assert rows(changed) == [("a", None, "1", "changed"), ("c", 3, "y!", "changed"), ("d", None, None, "gone"), ("e", None, None, "added")]
    assert rows(differences.difference_report(changed)) == [(1, 2, 1)]
    keyed = "k IS NOT NULL"
    assert rows(differences.apply_difference(before.where(keyed), changed, "k")) == rows(after.where(keyed))
    assert differences.difference(differences.state_of(after, "k"), after, "k").count() == 0
    nulls = spark.createDataFrame([("a", None, "x")], "k string, n string, t string"), spark.createDataFrame([("a", "x", None)], "k string, n string, t string")
    assert differences.difference(differences.state_of(nulls[0], "k"), nulls[1], "k").count() == 1  # a value moved to another column


def test_a_refresh_costs_its_changes(spark, tmp_path):
    """After changes to k nodes the difference has k rows; applied in place it writes their folders, and the mirror is that of a full refresh."""
    nodes = nodes_of(spark, [f"n{i}" for i in range(5000)])
    mirror = keyed_tables.create(lookups.mirror_of(nodes), str(tmp_path / "mirror"), "key", 256)
    later = nodes.where("name NOT IN ('n1', 'n2')").withColumn("POS", F.when(F.col("name").isin("n7", "n8", "n9"), "verb").otherwise(F.col("POS")))
    later = later.unionByName(nodes_of(spark, ["added"]))
    changed = differences.difference(differences.state_of(lookups.mirror_of(nodes), "key"), lookups.mirror_of(later), "key")
    assert changed.count() == 6
    outcome = keyed_tables.change(spark, mirror, changed, lambda part: differences.apply_difference(part, changed, "key"))
    assert (outcome.added, outcome.changed, outcome.gone) == (1, 3, 2) and len(outcome.buckets) <= 6
    assert rows(keyed_tables.read(spark, mirror)) == rows(lookups.mirror_of(later))
    full = lookups.refresh_mirror(lookups.mirror_of(nodes.where("name NOT IN ('n1', 'n2')")), later)
    assert rows(keyed_tables.read(spark, mirror)) == rows(full)


def test_the_mirror_key_of_a_name_finds_its_row(spark, tmp_path):
    nodes = nodes_of(spark, ["a", "b"])
    mirror = keyed_tables.create(lookups.mirror_of(nodes), str(tmp_path / "mirror"), "key", 4)
    keys = spark.createDataFrame([("a",)], "name string").select(mirror_key(F.col("name")).alias("word"))
    assert [r["name"] for r in lookups.mirror_nodes(keyed_tables.look_up(spark, mirror, keys)).collect()] == ["a"]


def test_flat_rows_survive_a_round_trip(spark, tmp_path):
    flat = lexicon_of(spark, 100)
    table = keyed_tables.create(flat, str(tmp_path / "t"), "word", 4)
    assert keyed_tables.read(spark, table).columns == FLAT.names and rows(keyed_tables.read(spark, table)) == rows(flat)
