"""Look-ups by word in the lexicon, the node mirror and the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.functions.parse import mirror_key, mirror_word
from wordbase.functions.text import capitalised
from wordbase.operators.keyed import as_keys, listed, look_up, matching, spread_join
from wordbase.operators.records import usable
from wordbase.runtime import stored
from wordbase.schemas import FLAT, NODE, NODE_PROPERTIES

WRITE_NULLS = {"ignoreNullFields": "false"}


# --- the flat lexicon ---------------------------------------------------


def find_words(lexicon: DataFrame, words: DataFrame | list[str]) -> DataFrame:
    """The full record of each word, with ``found`` telling known words from unknown ones."""
    keys = as_keys(lexicon, words)
    return look_up(keys, lexicon.select(*FLAT.names, F.lit(True).alias("found"))).select(
        *FLAT.names, F.coalesce("found", F.lit(False)).alias("found")
    )


def record_fields(records: DataFrame) -> DataFrame:
    """Every field of every record as a row ``word, field, value``."""
    text = records.select(
        "word", *(F.col(c).cast("string").alias(c) for c in FLAT.names if c != "word")
    )
    fields = [c for c in FLAT.names if c != "word"]
    return text.unpivot("word", fields, "field", "value").withColumn(
        "field", capitalised(F.col("field"))
    )


def record_json(records: DataFrame, *columns: str) -> DataFrame:
    """Each record as JSON text."""
    names = columns or tuple(records.columns)
    return records.select(F.to_json(F.struct(*names), WRITE_NULLS).alias("json"))


def stored_counts(lexicon: DataFrame, words: DataFrame | list[str]) -> DataFrame:
    """The count of each word, 0 for unknown words."""
    found = look_up(as_keys(lexicon, words), lexicon.select("word", "count"))
    return found.select("word", F.coalesce("count", F.lit(0).cast("long")).alias("count"))


# --- the node mirror ----------------------------------------------------


def node_json() -> Column:
    return F.to_json(F.struct(*NODE.names), WRITE_NULLS)


def mirror_of(nodes: DataFrame) -> DataFrame:
    """The key-value rows of all nodes that have a name."""
    return usable(nodes, "name").select(
        mirror_key(F.col("name")).alias("key"), node_json().alias("value")
    )


def refresh_mirror(mirror: DataFrame, nodes: DataFrame) -> DataFrame:
    """The mirror after all nodes are written to it; keys of other words stay."""
    fresh = mirror_of(nodes)
    return mirror.join(fresh.select("key"), "key", "left_anti").unionByName(fresh)


def refresh_report(nodes: DataFrame) -> DataFrame:
    """Node records read, nameless ones included, and mirror rows written."""
    named = F.col("name").isNotNull() & (F.col("name") != "")
    return nodes.agg(F.count("*").alias("records"), F.count_if(named).alias("written"))


def mirror_names(mirror: DataFrame) -> DataFrame:
    """Names of the mirrored words."""
    name = mirror_word(F.col("key"))
    return mirror.filter(F.col("key").startswith("lexicon:")).select(name.alias("name"))


def mirror_nodes(mirror: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """The mirror's rows parsed back to nodes, for ``names`` only if given.

    Rows are narrowed on their key first, so values of other words are never parsed.
    """
    rows = mirror
    if names is not None:
        rows = matching(mirror, names.select(mirror_key(F.col("name")).alias("key")), "key")
    name = mirror_word(F.col("key"))
    parsed = F.from_json("value", NODE)
    return rows.filter(F.col("key").startswith("lexicon:")).select(
        name.alias("name"), *(parsed[c].alias(c) for c in NODE_PROPERTIES)
    )


# --- both stores --------------------------------------------------------


def word_existence(
    words: DataFrame | list[str], mirror: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Per distinct word: how often it was asked for and which store has it.

    Repeats are counted before anything is joined, so a word that fills a third of the list
    is one row from then on. The counted list is written once: its known size decides whether the stores are shuffled, and a list that
    is derived is not made again for each of them.
    """
    if not isinstance(words, DataFrame):
        words = listed(nodes, words)
    wanted = stored(words.groupBy(F.col("word").alias("name")).agg(F.count("*").alias("occurrences")), "wanted")
    keys = wanted.select("name")
    sides = {"in_mirror": mirror_names(mirror), "in_graph": nodes.select("name")}
    hits = [
        matching(names, keys, "name").select("name", *(F.lit(flag == side).alias(flag) for flag in sides)) for side, names in sides.items()
    ]
    found = hits[0].unionByName(hits[1]).groupBy("name").agg(*(F.bool_or(flag).alias(flag) for flag in sides))
    has = {flag: F.coalesce(flag, F.lit(False)) for flag in sides}
    return wanted.join(found, "name", "left").select(
        F.col("name").alias("word"),
        "occurrences",
        *(value.alias(flag) for flag, value in has.items()),
        (has["in_mirror"] | has["in_graph"]).alias("found"),
    )


def neighbours(
    edges: DataFrame, nodes: DataFrame, words: DataFrame | list[str] | None = None
) -> DataFrame:
    """Outgoing relations with the related node's properties, one row per relation.

    Hubs, from which or to which a large part of all relations leads, are joined in pieces.
    """
    wanted = edges
    if words is not None:
        wanted = spread_join(edges, as_keys(edges, words, "src"), "src", "left_semi")
    related = nodes.select(
        F.col("name").alias("dst"), F.struct(*NODE.names).alias("related")
    )
    return spread_join(wanted, related, "dst", sizes_of=edges).select(
        F.col("src").alias("word"), F.col("rel").alias("relationship"), "related"
    )


def word_cards(words: DataFrame | list[str], nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Properties of each word in the graph, with one row per relation it has (or one row without).

    Words the graph does not have give no row.
    """
    keys = as_keys(nodes, words, "name")
    known = matching(nodes, keys, "name").select(*NODE.names)
    own = known.select(F.col("name").alias("src"), *NODE_PROPERTIES)
    wanted = spread_join(edges, own.select("src"), "src", "left_semi")
    having = spread_join(wanted, own, "src", sizes_of=edges).select(
        F.col("src").alias("name"), *NODE_PROPERTIES, F.col("rel").alias("relationship"), F.col("dst").alias("related_name")
    )
    alone = own.join(wanted.select("src").distinct(), "src", "left_anti").select(
        F.col("src").alias("name"), *NODE_PROPERTIES, *(F.lit(None).cast("string").alias(c) for c in ("relationship", "related_name"))
    )
    return having.unionByName(alone)


def read_through(
    words: DataFrame | list[str], mirror: DataFrame, nodes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Node of each word from the mirror or else from the graph, and the mirror rows to add.

    ``source`` is ``mirror``, ``graph`` or null for words neither has.
    """
    keys = as_keys(nodes, words, "name")
    cached = mirror_nodes(mirror, keys).select(
        "name", F.struct(*NODE_PROPERTIES).alias("cached")
    )
    in_graph = matching(nodes, keys, "name").select(
        "name", F.struct(*NODE_PROPERTIES).alias("stored")
    )
    both = keys.join(cached, "name", "left").join(in_graph, "name", "left")
    source = F.when(F.col("cached").isNotNull(), "mirror").when(
        F.col("stored").isNotNull(), "graph"
    )
    answer = both.select(
        "name", source.alias("source"), F.coalesce("cached", "stored").alias("node")
    ).select("name", "source", *(F.col(f"node.{c}").alias(c) for c in NODE_PROPERTIES))
    return answer, mirror_of(answer.filter(F.col("source") == "graph"))


def graph_answer() -> Column:
    """A node's properties under the names the graph store reports them."""
    return F.struct(
        F.col("POS").alias("part_of_speech"),
        "sentiment",
        "sentiment_score",
        F.col("meaning").alias("definition"),
    )


def compare_stores(
    words: DataFrame | list[str], mirror: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Both stores' answers for each word side by side, and whether they agree."""
    keys = as_keys(nodes, words, "name")
    cached = mirror_nodes(mirror, keys).select(
        "name", F.struct(*NODE.names).alias("mirror_data")
    )
    in_graph = matching(nodes, keys, "name").select("name", graph_answer().alias("graph_data"))
    m, g = F.col("mirror_data"), F.col("graph_data")
    pairs = (
        ("POS", "part_of_speech"),
        ("sentiment", "sentiment"),
        ("sentiment_score", "sentiment_score"),
        ("meaning", "definition"),
    )
    same = m.isNull() == g.isNull()
    for ours, theirs in pairs:
        same = same & m[ours].eqNullSafe(g[theirs])
    return (
        keys.join(cached, "name", "left")
        .join(in_graph, "name", "left")
        .select(F.col("name").alias("word"), "mirror_data", "graph_data", same.alias("agree"))
    )
