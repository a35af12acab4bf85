"""Keyed changes to the flat lexicon. Every function returns the table after the change.

The unchanged part of the lexicon is kept by an anti join on the changed keys and never
joined outer, so a small patch is broadcast and a huge lexicon is not shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.functions.parse import safe_double
from wordbase.operators.keyed import look_up, matching, one_per_key, without
from wordbase.schemas import FLAT, default_for, empty_like

ORDER = "seq"


class Changed(NamedTuple):
    lexicon: DataFrame
    rejects: DataFrame


def complete(data: DataFrame, *keep: str) -> DataFrame:
    """Data rows as full flat rows; columns they lack take their default."""
    return data.select(
        *(
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in data.columns
            else default_for(f.dataType).alias(f.name)
            for f in FLAT
        ),
        *keep,
    )


def _last(data: DataFrame) -> DataFrame:
    """One row per word: the last by ``seq`` where the data carries one."""
    if ORDER in data.columns:
        return one_per_key(data, "word", ORDER).drop(ORDER)
    return data


def insert_records(lexicon: DataFrame, data: DataFrame) -> DataFrame:
    """Add the rows as they are; no key is checked."""
    return lexicon.unionByName(complete(data))


def upsert(lexicon: DataFrame, data: DataFrame) -> DataFrame:
    """Replace or add whole rows by word.

    All fields are replaced: the ones the data lacks fall back to their default. ``data`` has
    one row per word, or a ``seq`` column by which the last row of a word counts.
    """
    patch = complete(_last(data))
    return without(lexicon, patch, "word").unionByName(patch)


def insert_absent(lexicon: DataFrame, data: DataFrame) -> DataFrame:
    """Add words the lexicon does not have; known words stay as they are."""
    rows = complete(_last(data))
    return lexicon.unionByName(without(rows, matching(lexicon, rows, "word"), "word"))


def _entry(data: DataFrame, count: Column) -> tuple[DataFrame, DataFrame]:
    """Entered fields as full rows, and the rows whose score is no number."""
    score = safe_double(F.col("sentiment_scores").cast("string"))
    scored = data.withColumn("sentiment_scores", score).withColumn("count", count)
    bad = scored.filter(score.isNull()).select("word", F.lit("score is no number").alias("reason"))
    return scored.filter(score.isNotNull()), bad


def enter_new(lexicon: DataFrame, data: DataFrame) -> Changed:
    """Manual entry of new words with count 1; known words are refused."""
    entered, bad = _entry(_last(data), F.lit(1).cast("long"))
    known = matching(lexicon, entered, "word").select("word")
    refused = matching(entered, known, "word").select("word", F.lit("already exists").alias("reason"))
    new = complete(without(entered, known, "word"))
    return Changed(lexicon.unionByName(new), bad.unionByName(refused))


def update_fields(lexicon: DataFrame, data: DataFrame) -> Changed:
    """Manual update: all fields are replaced except the count, which is kept (0 if unknown)."""
    entered, bad = _entry(_last(data), F.lit(0).cast("long"))
    stored = lexicon.select("word", F.col("count").alias("stored"))
    with_count = look_up(entered.drop("count"), stored).withColumn(
        "count", F.coalesce("stored", F.lit(0).cast("long"))
    )
    return Changed(upsert(lexicon, with_count.drop("stored")), bad)


# outcomes of a correction
KEPT, UPDATED, INSERTED, DECLINED = "kept", "updated", "inserted", "declined"
INVALID, BAD_SCORE = "invalid answer", "score is no number"


def route_corrections(lexicon: DataFrame, corrections: DataFrame) -> DataFrame:
    """Each correction with its ``outcome``, and the stored count of its word.

    Unknown words are inserted. Known ones are kept when marked correct, and updated when marked
    wrong and the change is confirmed. Answers are ``Y`` or ``N`` in either case.
    """
    latest = _last(corrections)
    stored = lexicon.select("word", F.col("count").alias("stored"), F.lit(True).alias("known"))
    right, go_on = F.upper("is_correct"), F.upper("proceed")
    score_ok = safe_double(F.col("sentiment_scores").cast("string")).isNotNull()
    change = F.when(~score_ok, BAD_SCORE)
    outcome = (
        F.when(F.col("known").isNull(), F.coalesce(change, F.lit(INSERTED)))
        .when(right == "Y", KEPT)
        .when((right == "N") & (go_on == "Y"), F.coalesce(change, F.lit(UPDATED)))
        .when((right == "N") & (go_on == "N"), DECLINED)
        .otherwise(INVALID)
    )
    return look_up(latest, stored).withColumn("outcome", outcome).drop("known")


def correct(lexicon: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lexicon after all corrections, and ``word, outcome`` of each."""
    routed = route_corrections(lexicon, corrections)
    changed = routed.filter(F.col("outcome").isin(INSERTED, UPDATED))
    patch = (
        changed.withColumn(
            "count",
            F.when(F.col("outcome") == INSERTED, 1)
            .otherwise(F.coalesce("stored", F.lit(0)))
            .cast("long"),
        )
        .withColumn("sentiment_scores", safe_double(F.col("sentiment_scores").cast("string")))
        .drop("stored", "outcome")
    )
    return upsert(lexicon, patch), routed.select("word", "outcome")


def flush(lexicon: DataFrame) -> DataFrame:
    """The emptied lexicon."""
    return empty_like(lexicon)
