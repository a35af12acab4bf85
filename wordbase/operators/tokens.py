"""Words of texts and how often they occur."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.functions.text import words


def token_rows(texts: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """One row per word occurrence; texts without a word give no row.

    ``keep`` names the columns carried along, so everything else is pruned from the scan.
    """
    return texts.select(*keep, F.explode(words(F.col(text))).alias("word"))


def word_counts(tokens: DataFrame, *by: str) -> DataFrame:
    """Occurrences per word (and per ``by``). Counted in the map tasks first, so the most
    frequent word costs the shuffle one row per task."""
    return tokens.groupBy(*by, "word").count()
