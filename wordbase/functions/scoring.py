"""Sentiment scoring columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The open interval in which a score says nothing
NEUTRAL_ABOVE, NEUTRAL_BELOW = 0.3, 0.7
NEUTRAL_LABEL, NEUTRAL_SCORE = "neutral", 0.5

Scorer = Callable[[list[str]], list[tuple[str, float]]]

#: of this worker process, by the token of the column function
_loaded: dict[str, Scorer] = {}


def neutral_band(label: Column, score: Column) -> tuple[Column, Column]:
    """Label and score, replaced where the score lies strictly inside the neutral band."""
    neutral = (score > NEUTRAL_ABOVE) & (score < NEUTRAL_BELOW)
    return (
        F.when(neutral, F.lit(NEUTRAL_LABEL)).otherwise(label),
        F.when(neutral, F.lit(NEUTRAL_SCORE)).otherwise(score),
    )


def model_scorer(load: Callable[[], Scorer]) -> Callable[[Column], Column]:
    """A column function ``word -> struct<label, score>`` around a model.

    ``load`` runs once per worker process, however many tasks it runs, and returns a function that
    scores a list of words; it gets whole Arrow batches, never single words.
    """
    token = uuid.uuid4().hex

    @F.pandas_udf("label string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if token not in _loaded:
            _loaded[token] = load()
        scorer = _loaded[token]
        for batch in batches:
            yield pd.DataFrame(scorer(batch.tolist()), columns=["label", "score"])

    return score
