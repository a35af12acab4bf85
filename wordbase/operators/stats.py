"""Counts, distributions, extremes, coverage and word lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.functions.text import percent_text, word_length
from wordbase.operators.lookups import mirror_names, word_existence
from wordbase.schemas import UNKNOWN_POS

# --- extremes -----------------------------------------------------------


def most_common(records: DataFrame, *then_by: str) -> DataFrame:
    """The record with the highest count; equal counts go by word, then by ``then_by``."""
    return records.orderBy(F.col("count").desc_nulls_last(), "word", *then_by).limit(1)


def least_common(records: DataFrame, *then_by: str) -> DataFrame:
    """The record with the lowest count, a missing count being the lowest."""
    return records.orderBy(F.col("count").asc_nulls_first(), "word", *then_by).limit(1)


# --- part of speech -----------------------------------------------------


def pos_segments(lexicon: DataFrame) -> DataFrame:
    """Words per part of speech in the flat lexicon; blank ones are left out, ``-`` is kept."""
    return lexicon.filter(F.col("pos") != "").groupBy("pos").agg(F.count("*").alias("words"))


def pos_distribution(nodes: DataFrame) -> DataFrame:
    """Nodes per part of speech with their share of all nodes, missing ones as UNKNOWN."""
    counts = nodes.groupBy(F.coalesce("POS", F.lit(UNKNOWN_POS)).alias("pos")).count()
    total = counts.agg(F.sum("count")).scalar()  # of the counts, so that the nodes are read once
    share = 100 * F.try_divide(F.col("count"), total)
    return counts.select("pos", "count", share.alias("percentage")).withColumn(
        "percent", percent_text(F.col("percentage"))
    )


def sorted_pos(nodes: DataFrame, order: str = "desc", limit: int | None = None) -> DataFrame:
    """The distribution by count, ``desc`` (also for a blank order) or ``asc``, all or some."""
    if order not in ("asc", "desc", ""):
        raise ValueError("order must be 'asc', 'desc' or blank")
    if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int) or limit <= 0):
        raise ValueError("limit must be a positive whole number or None")
    by = F.col("count").asc() if order == "asc" else F.col("count").desc()
    ranked = pos_distribution(nodes).orderBy(by, "pos")
    return ranked if limit is None else ranked.limit(limit)


def word_total(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.count("*").alias("total_words"))


def pos_total(nodes: DataFrame) -> DataFrame:
    """Distinct parts of speech; the missing one counts as one."""
    return general_counts(nodes).select("distinct_pos")


def general_counts(nodes: DataFrame) -> DataFrame:
    """Both totals in one row, counted per part of speech first."""
    return (
        nodes.groupBy(F.coalesce("POS", F.lit(UNKNOWN_POS)).alias("pos"))
        .count()
        .agg(
            F.coalesce(F.sum("count"), F.lit(0).cast("long")).alias("total_words"),
            F.count("*").alias("distinct_pos"),
        )
    )


# --- word length --------------------------------------------------------


def length_histogram(nodes: DataFrame, name: str = "name") -> DataFrame:
    return (
        nodes.groupBy(word_length(F.col(name)).alias("wordLength")).count().orderBy("wordLength")
    )


def _mean():
    mean = F.try_divide(F.sum(F.col("wordLength") * F.col("count")), F.sum("count"))
    return F.coalesce(mean, F.lit(0.0)).alias("mean_length")


def _median():
    # weighted by count over the histogram: no row is ever repeated
    return F.percentile(F.col("wordLength"), 0.5, F.col("count")).alias("median_length")


def mean_length(histogram: DataFrame) -> DataFrame:
    """Mean word length over a histogram, 0.0 when it holds no word."""
    return histogram.agg(_mean())


def median_length(histogram: DataFrame) -> DataFrame:
    """Exact median word length over a histogram, null when it holds no word."""
    return histogram.agg(_median())


def length_summary(histogram: DataFrame) -> DataFrame:
    return histogram.agg(_mean(), _median())


# --- coverage and size --------------------------------------------------


def coverage_report(words: DataFrame | list[str], mirror: DataFrame, nodes: DataFrame) -> DataFrame:
    """Found or not per word, with the number of times it was asked for."""
    return word_existence(words, mirror, nodes).select("word", "occurrences", "found")


def coverage(words: DataFrame | list[str], mirror: DataFrame, nodes: DataFrame) -> DataFrame:
    """Share of the list that either store has; every repeat counts. Null for no words."""
    found = F.coalesce(F.sum(F.when(F.col("found"), F.col("occurrences"))), F.lit(0))
    asked = F.coalesce(F.sum("occurrences"), F.lit(0))
    return (
        coverage_report(words, mirror, nodes)
        .agg(asked.cast("long").alias("asked"), found.cast("long").alias("found"))
        .withColumn("coverage", 100 * F.try_divide(F.col("found"), F.col("asked")))
        .withColumn("percent", percent_text(F.col("coverage")))
    )


def mirrored_total(mirror: DataFrame) -> DataFrame:
    """Number of words in the mirror; keys of other kinds do not count."""
    return mirror_names(mirror).agg(F.count("*").alias("mirrored_words"))


def lexicon_size(mirror: DataFrame, nodes: DataFrame) -> DataFrame:
    """Words in the mirror, in the graph and in either, from one aggregate over both."""
    tagged = (
        mirror_names(mirror)
        .select("name", F.lit(1).alias("m"), F.lit(0).alias("g"))
        .unionByName(nodes.select("name", F.lit(0).alias("m"), F.lit(1).alias("g")))
    )
    return (
        tagged.groupBy("name")
        .agg(F.sum("m").alias("m"), F.sum("g").alias("g"))
        .agg(
            *(
                F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(name)
                for c, name in (("m", "mirror_words"), ("g", "graph_words"))
            ),
            F.count("*").alias("total_words"),
        )
    )


def row_total(table: DataFrame) -> DataFrame:
    """All rows of an import, new words or not."""
    return table.agg(F.count("*").alias("rows"))
