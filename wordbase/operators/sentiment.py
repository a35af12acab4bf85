"""Sentiment of words: scoring, look-up and proportions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordbase.functions.scoring import neutral_band
from wordbase.functions.text import capitalised, percent_text
from wordbase.operators.keyed import as_keys, look_up, matching, without
from wordbase.operators.sentiment_model import predicted
from wordbase.schemas import (
    FREQUENCY,
    NO_SCORE,
    NO_TEXT,
    NOT_AVAILABLE,
    SCORED,
    SENTIMENTS,
)
from wordbase.sources import runs


def score_sentiment(
    frequencies: DataFrame, scorer: DataFrame | PipelineModel | Callable[[Column], Column]
) -> DataFrame:
    """``word, count, sentiment, sentiment_score`` for a frequency table.

    ``scorer`` is a table ``word, label, score`` that is joined, a model fitted by ``sentiment_model``, or a column function that
    returns ``struct<label, score>`` (see ``model_scorer``). Words a table does not score get
    ``-`` and 0.0. Scores inside the neutral band become neutral.
    """
    if isinstance(scorer, DataFrame):
        scored = frequencies.join(scorer.select("word", "label", "score"), "word", "left")
    elif isinstance(scorer, PipelineModel):
        scored = predicted(frequencies.select("word", "count"), scorer)
    else:
        scored = frequencies.withColumn("scored", scorer(F.col("word"))).select(
            "word", "count", "scored.label", "scored.score"
        )
    label, score = neutral_band(F.col("label"), F.col("score"))
    return scored.select(
        "word",
        "count",
        F.coalesce(label, F.lit(NO_TEXT)).alias("sentiment"),
        F.coalesce(score, F.lit(NO_SCORE)).alias("sentiment_score"),
    )


# Which area each annotated area is made from
ANNOTATED_FROM = {runs.CLEANED: runs.LABELLED_CLEANED, runs.UPDATE: runs.LABELLED_UPDATE}


def annotate_run(
    spark: SparkSession,
    root: str,
    area: str,
    stamp: str,
    owner: str,
    scorer: DataFrame | PipelineModel | Callable[[Column], Column],
) -> str:
    """Score one run of the cleaned or the update area into its labelled area."""
    if area not in ANNOTATED_FROM:
        raise ValueError(f"no input area {area!r}, expected one of {', '.join(ANNOTATED_FROM)}")
    frequencies = runs.read_run(spark, root, area, stamp, owner, FREQUENCY)
    scored = score_sentiment(frequencies, scorer)
    return runs.write_run(
        scored.select(*SCORED.names), root, ANNOTATED_FROM[area], stamp, owner
    )


def sentiment_proportions(lexicon: DataFrame) -> DataFrame:
    """Words and share per sentiment class; classes without words are listed with 0.

    Other labels count neither as a class nor in the total. One aggregate with a counter per
    class; without any classified word the shares are null.
    """
    counts = lexicon.filter(F.col("sentiment").isin(*SENTIMENTS)).agg(
        *(F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENTS)
    )
    total = sum((F.col(s) for s in SENTIMENTS), F.lit(0))
    proportion = F.try_divide(F.col("words"), F.col("total"))
    return (
        counts.withColumn("total", total)
        .unpivot("total", list(SENTIMENTS), "sentiment", "words")
        .select(
            "sentiment",
            capitalised(F.col("sentiment")).alias("label"),
            "words",
            proportion.alias("proportion"),
            percent_text(100 * proportion).alias("percent"),
        )
    )


def word_sentiment(
    lexicon: DataFrame, words: DataFrame | list[str]
) -> tuple[DataFrame, DataFrame]:
    """Sentiment and score (as text) of each word, ``N/A`` where there is none; and the
    words the lexicon does not have, which are to be inserted."""
    keys = as_keys(lexicon, words)
    known = lexicon.select("word", "sentiment", "sentiment_scores", F.lit(True).alias("known"))
    found = look_up(keys, known).select(
        "word",
        F.coalesce("known", F.lit(False)).alias("found"),
        *(
            F.coalesce(F.col(c).cast("string"), F.lit(NOT_AVAILABLE)).alias(c)
            for c in ("sentiment", "sentiment_scores")
        ),
    )
    return found, without(keys, matching(lexicon, keys, "word"), "word")
