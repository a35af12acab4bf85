"""Changes to the word graph and its mirror. Every function returns the state after it.

The mirror has one key rule and always follows from the nodes: refresh it with
``lookups.refresh_mirror`` (or drop keys with ``delete_keys``) after changing nodes.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.functions.parse import (
    blank_to_null,
    key_matches,
    mirror_key,
    relation_type,
    safe_double,
    stripped,
)
from wordbase.operators.keyed import last_given, matching, one_per_key, spread_join, without
from wordbase.operators.lookups import mirror_names
from wordbase.schemas import EDGE, NODE, NODE_PROPERTIES

ORDER = "seq"


class Graph(NamedTuple):
    nodes: DataFrame
    edges: DataFrame
    rejects: DataFrame


class Deleted(NamedTuple):
    nodes: DataFrame
    edges: DataFrame
    mirror: DataFrame | None
    rejects: DataFrame


class Nodes(NamedTuple):
    nodes: DataFrame
    rejects: DataFrame


def _reject(df: DataFrame, reason: str, *names: str) -> DataFrame:
    return df.select(*names, F.lit(reason).alias("reason"))


# --- new nodes ----------------------------------------------------------


def create_nodes(nodes: DataFrame, new: DataFrame, mirror: DataFrame | None = None) -> DataFrame:
    """Add nodes whose word neither the graph nor the mirror has; the others stay untouched.

    If a new word comes several times, its first row by ``seq`` is the one created.
    """
    first = one_per_key(new, "name", ORDER, last=False) if ORDER in new.columns else new
    rows = first.select(*NODE.names)
    absent = without(rows, matching(nodes, rows, "name"), "name")
    if mirror is not None:
        absent = without(absent, matching(mirror_names(mirror), rows, "name"), "name")
    return nodes.select(*NODE.names).unionByName(absent)


# --- merged pairs -------------------------------------------------------


def _folded(patches: DataFrame, order: list[str]) -> DataFrame:
    """One patch per name: per property the value given last."""
    return patches.groupBy("name").agg(
        *(last_given(F.col(c), order).alias(c) for c in NODE_PROPERTIES)
    )


def _patched(nodes: DataFrame, patch: DataFrame) -> DataFrame:
    """Nodes with the given properties replaced; nodes without a patch stay as they are."""
    given = patch.select("name", *(F.col(c).alias(f"new_{c}") for c in NODE_PROPERTIES))
    return nodes.join(given, "name", "left").select(
        "name", *(F.coalesce(f"new_{c}", c).alias(c) for c in NODE_PROPERTIES)
    )


def merge_pairs(nodes: DataFrame, edges: DataFrame, pairs: DataFrame) -> Graph:
    """Create or update two words per row and put a relation between them.

    ``pairs(seq, word1, properties1, word2, properties2, relationship)``; the properties are
    structs of any node properties. Given properties replace stored ones, null ones leave them.
    Rows with an unknown relation are refused as a whole.
    """
    typed = pairs.withColumn("rel", relation_type(F.col("relationship")))
    valid = typed.filter(F.col("rel").isNotNull())

    def side(number: int) -> DataFrame:
        given = valid.schema[f"properties{number}"].dataType.names
        properties = F.col(f"properties{number}")
        return valid.select(
            F.col(f"word{number}").alias("name"),
            ORDER,
            F.lit(number).alias("side"),
            *(
                (properties[c] if c in given else F.lit(None)).cast(NODE[c].dataType).alias(c)
                for c in NODE_PROPERTIES
            ),
        )

    patch = _folded(side(1).unionByName(side(2)), [ORDER, "side"])
    created = without(patch, matching(nodes, patch, "name"), "name")
    relations = valid.select(F.col("word1").alias("src"), "rel", F.col("word2").alias("dst")).distinct()
    # stored relations are unique, so only the new ones are compared
    there = matching(edges, relations, EDGE.names).select(*EDGE.names)
    return Graph(
        _patched(nodes, patch).unionByName(created.select(*NODE.names)),
        edges.select(*EDGE.names).unionByName(without(relations, there, EDGE.names).select(*EDGE.names)),
        _reject(
            typed.filter(F.col("rel").isNull()), "unknown relation", "word1", "word2", "relationship"
        ),
    )


# --- patches ------------------------------------------------------------


def patch_nodes(nodes: DataFrame, patch: DataFrame) -> Nodes:
    """Set the properties that are filled in; blank ones and bad scores are skipped.

    ``patch(name, POS, sentiment, sentiment_score, meaning)`` as text, with an optional ``seq``
    when a word may come more than once. Unknown words are refused.
    """
    given = patch.select(
        "name",
        *((ORDER,) if ORDER in patch.columns else ()),
        *(
            (safe_double if c == "sentiment_score" else blank_to_null)(
                F.col(c).cast("string")
            ).alias(c)
            for c in NODE_PROPERTIES
        ),
    )
    folded = _folded(given, [ORDER]) if ORDER in patch.columns else given
    unknown = without(folded, matching(nodes, folded, "name"), "name")
    return Nodes(_patched(nodes, folded), _reject(unknown, "unknown word", "name"))


def split_by_ends(patch: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Relation rows whose two words exist, and the others with the reason. Rows that repeat are one."""
    sides = F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).alias("name")) for c in ("src", "dst")))
    ends = patch.select(*patch.columns, F.explode(sides).alias("end")).select(*patch.columns, "end.*")
    known = matching(nodes, ends.select("name").distinct(), "name").select("name", F.lit(True).alias("known"))
    checked = spread_join(ends, known, "name", "left")
    has = {c: F.coalesce(F.bool_or((F.col("side") == c) & F.col("known")), F.lit(False)).alias(f"has_{c}") for c in ("src", "dst")}
    reason = F.when(~F.col("has_src"), "unknown word").when(~F.col("has_dst"), "unknown related word")
    judged = checked.groupBy(*patch.columns).agg(*has.values()).withColumn("reason", reason)
    accepted = judged.filter(F.col("reason").isNull()).select(*patch.columns)
    return accepted, judged.filter(F.col("reason").isNotNull()).select("src", "dst", "reason")


def set_relations(nodes: DataFrame, edges: DataFrame, patch: DataFrame) -> Graph:
    """Set the relation of ordered pairs, replacing every relation the pair had.

    ``patch(src, dst, rel)`` with an optional ``seq``: the last row of a pair counts.
    """
    typed = patch.withColumn("rel", relation_type(F.col("rel")))
    valid = typed.filter(F.col("rel").isNotNull())
    if ORDER in patch.columns:
        pair = F.struct("src", "dst")
        valid = one_per_key(
            valid.select(pair.alias("pair"), ORDER, "rel"), "pair", ORDER
        ).select("pair.src", "pair.dst", "rel")
    accepted, rejects = split_by_ends(valid.select("src", "dst", "rel"), nodes)
    bad = _reject(typed.filter(F.col("rel").isNull()), "unknown relation", "src", "dst")
    kept = without(edges, accepted, ["src", "dst"])
    return Graph(
        nodes,
        kept.select(*EDGE.names).unionByName(accepted.select(*EDGE.names)),
        bad.unionByName(rejects),
    )


# --- deletes ------------------------------------------------------------


def delete_nodes(
    nodes: DataFrame, edges: DataFrame, requests: DataFrame, mirror: DataFrame | None = None
) -> Deleted:
    """Delete confirmed words with all relations from and to them, and their mirror rows.

    ``requests(name, confirm)``: the confirmation has to repeat the word. Words that are unknown or not
    confirmed keep their mirror rows.
    """
    requests = requests.select("name", "confirm").distinct()
    known = matching(nodes, requests, "name").select("name")
    confirmed = F.coalesce(stripped(F.col("confirm")) == F.col("name"), F.lit(False))
    asked = matching(requests, known, "name")
    doomed = asked.filter(confirmed).select("name").distinct()
    rejects = _reject(without(requests, known, "name"), "unknown word", "name").unionByName(
        _reject(asked.filter(~confirmed), "not confirmed", "name")
    )
    kept = edges
    for end in ("src", "dst"):
        kept = spread_join(kept, doomed.withColumnRenamed("name", end), end, "left_anti", edges)
    left = None if mirror is None else drop_mirrored(mirror, doomed)
    return Deleted(without(nodes, doomed, "name"), kept.select(*EDGE.names), left, rejects)


def drop_mirrored(mirror: DataFrame, names: DataFrame) -> DataFrame:
    """The mirror without the given words."""
    return without(mirror, names.select(mirror_key(F.col("name")).alias("key")), "key")


def delete_keys(mirror: DataFrame, pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """The mirror without the keys a glob matches, and the number deleted."""
    hit = key_matches(F.col("key"), pattern)
    return mirror.filter(~hit), mirror.agg(F.count_if(hit).alias("deleted"))
