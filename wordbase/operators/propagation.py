"""Sentiment spread along relations: from words that have one to words related to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.operators.keyed import matching, spread_join, without
from wordbase.runtime import stored

#: what a relation says of the sentiment of its two words
SIGNS = {"SYNONYM_OF": 1, "ANTONYM_OF": -1}
WRITE_TOGETHER = 16  #: rounds after which the tables of single rounds are written as one


def signed_links(edges: DataFrame) -> DataFrame:
    """``src, dst, agrees`` in both directions: 1 between synonyms, -1 between antonyms; relations of a word to itself are left out."""
    agrees = F.coalesce(*(F.when(F.col("rel") == rel, sign) for rel, sign in SIGNS.items()))
    pairs = edges.where(F.col("rel").isin(*SIGNS) & (F.col("src") != F.col("dst")))
    ends = F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("ends")
    return pairs.select(ends, agrees.alias("agrees")).select("ends.*", "agrees").distinct()


def spread_sentiment(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """``word, sign, round``: the seeds (``word, sign``: 1 or -1; one row a word) in round 0, and every word they reach.

    In each round the words that got a sign in the round before vote at their relations, for their own sign between synonyms and for the
    other one between antonyms. A word without a sign takes that of the majority and keeps it; in a tie it stays without one and may get it in a later round.
    It ends when a round gives no word a sign, or after ``rounds``.

    Each round is a written table of the words it reached. Votes are added up before and after one shuffle of the relations of these words;
    relations of a hub are joined in pieces, by degrees that are counted once.
    """
    links = stored(signed_links(edges), "links")
    degrees = stored(links.groupBy("src").agg(F.count("*").alias("size")), "link_degrees")
    last = stored(seeds.select("word", F.col("sign").cast("int").alias("sign"), F.lit(0).alias("round")), "signed")
    signed, n = last, 0
    while rounds is None or n < rounds:
        n += 1
        # only relations of the words of the last round are joined; most rounds reach few
        own = last.select(F.col("word").alias("src"), "sign")
        voting = spread_join(links, own, "src", sizes_of=matching(degrees, own, "src"), size="size")
        votes = voting.groupBy(F.col("dst").alias("word")).agg(F.sum(F.col("agrees") * F.col("sign")).alias("votes")).where("votes <> 0")
        last = stored(without(votes, signed, "word").select("word", F.signum("votes").cast("int").alias("sign"), F.lit(n).alias("round")), "signed")
        if last.isEmpty():
            break
        signed = signed.unionByName(last)
        if n % WRITE_TOGETHER == 0:
            signed = stored(signed, "signed")
    return signed
