"""New words of a batch, and loading them back after annotation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordbase.operators.keyed import matching, without
from wordbase.operators.records import append_records, build_lexicon, shape_records
from wordbase.operators.tokens import word_counts
from wordbase.schemas import COMPLETED
from wordbase.sources import runs


def new_words(batch: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Distinct words of the batch that the lexicon does not have; nulls compare equal.

    The lexicon is narrowed to the batch's words first: a short batch is broadcast, and the lexicon only scanned.
    """
    words = batch.select("word").distinct()
    same = F.col("lexicon.word").eqNullSafe(F.col("words.word"))
    known = lexicon.select("word").alias("lexicon").join(words.alias("words"), same, "left_semi")
    return words.subtract(known)


def new_word_counts(batch: DataFrame, lexicon: DataFrame, frequency: str = "reference") -> DataFrame:
    """New words with a count, the table that goes out for annotation.

    ``frequency="reference"`` counts the distinct new words, which is 1 each;
    ``"corpus"`` keeps the count each word has in the batch (``word, count``).
    """
    if frequency == "reference":
        return word_counts(new_words(batch, lexicon))
    if frequency == "corpus":
        rows = batch.select("word", "count")
        return without(rows, matching(lexicon, rows, "word"), "word")
    raise ValueError("frequency must be 'reference' or 'corpus'")


def export_new_words(
    batch: DataFrame,
    lexicon: DataFrame,
    root: str,
    when: datetime,
    owner: str,
    frequency: str = "reference",
) -> str:
    table = new_word_counts(batch, lexicon, frequency)
    return runs.write_run(table, root, runs.UPDATE, runs.run_stamp(when), owner)


# Where a finished update is picked up
IMPORT_AREAS = {1: runs.LABELLED_UPDATE, 2: runs.UPDATE}


def import_update(
    spark: SparkSession,
    records: DataFrame,
    root: str,
    scenario: int,
    stamp: str,
    owner: str,
    seq: int,
) -> tuple[DataFrame, DataFrame]:
    """Append one annotated update to the records; returns the records and the new lexicon.

    Scenario 1 reads the labelled area, 2 the update area annotated in place. Importing a run
    twice repeats its records, and the lexicon still holds each word once.
    """
    if scenario not in IMPORT_AREAS:
        raise ValueError("scenario must be 1 (labelled update) or 2 (update)")
    rows = runs.read_run(spark, root, IMPORT_AREAS[scenario], stamp, owner, COMPLETED)
    appended = append_records(records, shape_records(rows, seq))
    return appended, build_lexicon(appended)
