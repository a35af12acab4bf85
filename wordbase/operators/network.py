"""The relation graph as an undirected network: size, degrees, clusters, related words."""

from __future__ import annotations

import math
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.functions.parse import relation_name
from wordbase.operators.keyed import listed, matching
from wordbase.runtime import stored

EXACT_DEGREES = 5_000  #: distinct degrees that are told apart one by one
DEGREE_ERROR = 0.002


def relation_edges(edges: DataFrame, relation: str) -> DataFrame:
    """Directed pairs of one relation; either spelling of its name."""
    return edges.filter(F.col("rel") == relation_name(relation)).select("src", "dst")


def related_words(edges: DataFrame, relation: str, limit: int = 5) -> DataFrame:
    """All related words of the first ``limit`` words that have the relation.

    One row per related word instead of one list per word: a hub may be related to a third of
    the vocabulary. The words are picked first, so only their relations are read further.
    """
    pairs = relation_edges(edges, relation)
    first = pairs.select("src").distinct().orderBy("src").limit(limit)
    return matching(pairs, first, "src").select(
        F.col("src").alias("word"), F.col("dst").alias("related")
    )


def undirected(pairs: DataFrame) -> DataFrame:
    """The simple graph: each connected pair once, whatever its directions."""
    return pairs.select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    ).distinct()


def degrees(graph: DataFrame) -> DataFrame:
    """Degree of each node; a self-loop counts twice."""
    return graph.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
        F.count("*").alias("degree")
    )


def graph_summaries(edges: DataFrame, relations: list[str]) -> DataFrame:
    """Nodes and edges of the simple graph of each relation, in one pass over all of them; 0 for a relation without any.

    Every edge adds two to the sum of degrees.
    """
    names = listed(edges, dict.fromkeys(map(relation_name, relations)), "relation")
    pairs = edges.filter(F.col("rel").isin(*{relation_name(r) for r in relations})).select(
        F.col("rel").alias("relation"), F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    )
    ends = pairs.distinct().select("relation", F.explode(F.array("a", "b")).alias("node"))
    degree = ends.groupBy("relation", "node").agg(F.count("*").alias("degree"))
    sizes = degree.groupBy("relation").agg(F.count("*").alias("nodes"), F.expr("sum(degree) div 2").alias("edges"))
    none = F.lit(0).cast("long")
    return names.join(sizes, "relation", "left").select("relation", *(F.coalesce(c, none).alias(c) for c in ("nodes", "edges")))


def graph_summary(edges: DataFrame, relation: str) -> DataFrame:
    return graph_summaries(edges, [relation])


class Bin(NamedTuple):
    """Values that are next to one another: the largest, their number, sum and sum of squares."""

    end: int
    n: int
    total: int
    squares: int


def best_bin_ranges(bins: list[Bin], k: int) -> list[int]:
    """The upper ends of the ``k`` ranges of bins with the least squared distance of values to the means of their ranges.

    Best clusters of numbers are ranges, so the best ones come from a table: the least
    cost of the first bins in so many ranges, in n log n steps for each range. Fewer bins than ranges are a range each. All sums are whole
    numbers and costs are compared exactly.
    """
    weight, total, squares = [0], [0], [0]
    for own in bins:
        weight.append(weight[-1] + own.n)
        total.append(total[-1] + own.total)
        squares.append(squares[-1] + own.squares)

    def cost(i: int, j: int) -> Fraction:
        n, s = weight[j] - weight[i], total[j] - total[i]
        return squares[j] - squares[i] - Fraction(s * s, n)

    count = len(bins)
    k = min(k, count)
    best: list[Fraction] = [Fraction(0), *(cost(0, j) for j in range(1, count + 1))]
    cuts: list[list[int]] = []
    for parts in range(2, k + 1):
        now, cut = [Fraction(0)] * (count + 1), [0] * (count + 1)
        # the best last cut never moves back as more bins come in, so halves can be searched apart
        open_ = [(parts, count, parts - 1, count - 1)]
        while open_:
            low, high, first, last = open_.pop()
            if low > high:
                continue
            j = (low + high) // 2
            now[j], cut[j] = min((best[i] + cost(i, j), i) for i in range(first, min(last, j - 1) + 1))
            open_ += [(low, j - 1, first, cut[j]), (j + 1, high, cut[j], last)]
        best = now
        cuts.append(cut)
    ends = [count] if bins else []
    for cut in reversed(cuts):
        ends.append(cut[ends[-1]])
    return [bins[j - 1].end for j in reversed(ends)]


def best_ranges(histogram: list[tuple[int, int]], k: int) -> list[int]:
    """The same for a sorted list of (value, number of values)."""
    return best_bin_ranges([Bin(v, n, n * v, n * v * v) for v, n in histogram], k)


def degree_bins(node_degrees: DataFrame) -> list[Bin]:
    """The distinct degrees with their number of nodes; if there are more than ``EXACT_DEGREES``, degrees within a factor of
    1 + ``DEGREE_ERROR`` of one another in one bin, of which there are no more than the logarithm of the largest degree by that of the factor."""
    histogram = stored(node_degrees.groupBy("degree").agg(F.count("*").alias("n")), "degree_histogram")
    exact = histogram.limit(EXACT_DEGREES + 1).count() <= EXACT_DEGREES
    place = F.col("degree") if exact else F.floor(F.log("degree") / math.log1p(DEGREE_ERROR))
    n, degree = (F.col(c).cast("decimal(38,0)") for c in ("n", "degree"))
    # squares of degrees pass a long; the sums are exact
    by_place = histogram.groupBy(place.alias("place")).agg(
        F.max("degree").alias("end"), F.sum(n).alias("n"), F.sum((n * degree).cast("decimal(38,0)")).alias("total"),
        F.sum((n * degree * degree).cast("decimal(38,0)")).alias("squares"),
    )
    return sorted(Bin(*(int(r[c]) for c in Bin._fields)) for r in by_place.drop("place").collect())


def degree_clusters(node_degrees: DataFrame, k: int = 3) -> DataFrame:
    """Nodes with the cluster of their degree; clusters are numbered by rising degree.

    Equal degrees always share a cluster, so the clusters are found on the distinct degrees weighted
    by their number of nodes, as the exact solution in one dimension. n distinct degrees need at least n * n / 4 edges,
    so the histogram is short; beyond ``EXACT_DEGREES`` clusters begin at the borders of bins, so a
    border is off by a factor of 1 + ``DEGREE_ERROR`` at most, while the costs are still those of the single degrees. The degrees are written once, because
    both steps read them.
    """
    node_degrees = stored(node_degrees.select("node", "degree"), "degrees")
    ends = best_bin_ranges(degree_bins(node_degrees), k)
    cluster = F.lit(0)
    for end in ends[:-1]:
        cluster = cluster + (F.col("degree") > end).cast("int")
    return node_degrees.select("node", "degree", cluster.alias("cluster"))


def first_nodes(clusters: DataFrame, limit: int = 5) -> DataFrame:
    return clusters.orderBy("node").limit(limit)
