"""Annotated records, and the flat table with one row per word that answers queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.functions.parse import safe_count
from wordbase.operators.keyed import one_per_key
from wordbase.schemas import ANNOTATION, FLAT, NODE, RECORD, default_for

# Fixed value: input columns of a completed annotation table -> fields of the annotation
ANNOTATION_INPUTS = {
    "sentiment": "sentiment",
    "sentiment_score": "sentiment_scores",
    "synonym": "synonyms",
    "antonyms": "antonyms",
    "hypernyms": "hypernyms",
    "meronyms": "meronyms",
}
ORDER = "seq"


def _given(df: DataFrame, column: str, kind) -> Column:
    """The column as it is, nulls included, or the default where the table lacks it."""
    return F.col(column).cast(kind) if column in df.columns else default_for(kind)


def shape_records(rows: DataFrame, seq: int | None = None) -> DataFrame:
    """Completed annotation rows as nested records.

    Rows without a count and repeated header rows (count ``count``) are dropped. Bad counts
    become 0. ``seq`` stamps the load; without it an existing ``seq`` column is carried along.
    """
    count_kind = dict(rows.dtypes)["count"]
    kept = rows.filter(F.col("count").isNotNull())
    if count_kind == "string":
        kept = kept.filter(F.col("count") != "count")
    annotation = F.struct(
        *(
            _given(rows, column, ANNOTATION[field].dataType).alias(field)
            for column, field in ANNOTATION_INPUTS.items()
        )
    )
    shaped = [
        F.col("word"),
        safe_count(F.col("count"), count_kind).alias("count"),
        annotation.alias("annotation"),
        _given(rows, "meaning", RECORD["meaning"].dataType).alias("meaning"),
        _given(rows, "POS", RECORD["pos"].dataType).alias("pos"),
    ]
    if seq is not None:
        shaped.append(F.lit(seq).cast("long").alias(ORDER))
    elif ORDER in rows.columns:
        shaped.append(F.col(ORDER))
    return kept.select(*shaped)


def append_records(records: DataFrame, new: DataFrame) -> DataFrame:
    """All records of both; words may repeat."""
    return records.unionByName(new, allowMissingColumns=True)


def usable(df: DataFrame, word: str = "word") -> DataFrame:
    """Rows with a word in them."""
    return df.filter(F.col(word).isNotNull() & (F.col(word) != ""))


def flatten(records: DataFrame, *keep: str) -> DataFrame:
    """Records as flat rows, defaults for every null; rows without a word are left out."""
    nested = {
        field.name: F.col(f"annotation.{field.name}") for field in ANNOTATION
    }
    return usable(records).select(
        *(
            F.coalesce(nested.get(f.name, F.col(f.name)), default_for(f.dataType)).alias(f.name)
            for f in FLAT
        ),
        *keep,
    )


def nest(flat: DataFrame, *keep: str) -> DataFrame:
    """Flat rows back as nested records."""
    return flat.select(
        "word",
        "count",
        F.struct(*ANNOTATION.names).alias("annotation"),
        "meaning",
        "pos",
        *keep,
    )


def build_lexicon(records: DataFrame) -> DataFrame:
    """The flat table, one row per word: the last loaded record of a word counts."""
    return one_per_key(flatten(records, ORDER), "word", ORDER).drop(ORDER)


def load_report(rows: DataFrame) -> DataFrame:
    """One row: how many input rows shape into records, and how many are skipped and why."""
    header = (
        F.col("count") == "count" if dict(rows.dtypes)["count"] == "string" else F.lit(False)
    )
    no_count = F.col("count").isNull()
    no_word = F.col("word").isNull() | (F.col("word") == "")
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(~no_count & ~header).alias("records"),
        F.count_if(no_count).alias("without_count"),
        F.count_if(header).alias("repeated_headers"),
        F.count_if(~no_count & ~header & no_word).alias("without_word"),
    )


def nodes_from_lexicon(lexicon: DataFrame) -> DataFrame:
    """The adapter between the two shapes: flat rows as graph nodes."""
    return lexicon.select(
        F.col("word").alias("name"),
        F.col("pos").alias("POS"),
        "sentiment",
        F.col("sentiment_scores").alias("sentiment_score"),
        "meaning",
    ).select(*NODE.names)
