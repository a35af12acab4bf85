"""Table shapes, defaults and relation names used across the package."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------
NO_TEXT = "-"
NO_SCORE = 0.0
NO_COUNT = 0
UNKNOWN_POS = "UNKNOWN"
NOT_AVAILABLE = "N/A"
SENTIMENTS = ("positive", "negative", "neutral")
RELATIONS = (
    "SYNONYM_OF",
    "ANTONYM_OF",
    "HYPERNYM_OF",
    "HYPONYM_OF",
    "MERONYM_OF",
    "HOLONYM_OF",
)
WORD_PREFIX = "word:"
MIRROR_PREFIX = "lexicon:"
# ------------------------------------------------------------------------

_STR, _LONG, _DOUBLE, _INT = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


FREQUENCY = _struct(("word", _STR), ("count", _LONG))
SCORED = _struct(
    ("word", _STR), ("count", _LONG), ("sentiment", _STR), ("sentiment_score", _DOUBLE)
)
COMPLETED = _struct(
    ("word", _STR),
    ("count", _STR),
    ("sentiment", _STR),
    ("sentiment_score", _DOUBLE),
    ("synonym", _STR),
    ("antonyms", _STR),
    ("hypernyms", _STR),
    ("meronyms", _STR),
    ("meaning", _STR),
    ("POS", _STR),
)
ANNOTATION = _struct(
    ("sentiment", _STR),
    ("sentiment_scores", _DOUBLE),
    ("synonyms", _STR),
    ("antonyms", _STR),
    ("hypernyms", _STR),
    ("meronyms", _STR),
)
RECORD = _struct(
    ("word", _STR),
    ("count", _LONG),
    ("annotation", ANNOTATION),
    ("meaning", _STR),
    ("pos", _STR),
)
FLAT = _struct(
    ("word", _STR),
    ("count", _LONG),
    ("meaning", _STR),
    ("pos", _STR),
    ("sentiment", _STR),
    ("sentiment_scores", _DOUBLE),
    ("synonyms", _STR),
    ("antonyms", _STR),
    ("hypernyms", _STR),
    ("meronyms", _STR),
)
NODE = _struct(
    ("name", _STR),
    ("POS", _STR),
    ("sentiment", _STR),
    ("sentiment_score", _DOUBLE),
    ("meaning", _STR),
)
MIRROR = _struct(("key", _STR), ("value", _STR))
EDGE = _struct(("src", _STR), ("rel", _STR), ("dst", _STR))
HISTOGRAM = _struct(("wordLength", _INT), ("count", _LONG))
MESSAGE = _struct(("message_id", _STR), ("category", _STR), ("part", _INT), ("parts", _INT), ("value", _STR))
TITLES = T.ArrayType(_STR)

NODE_PROPERTIES = tuple(name for name in NODE.names if name != "name")


def default_for(kind: T.DataType) -> Column:
    """The value a missing field takes: ``-`` for text, 0.0 for scores, 0 for counts."""
    if isinstance(kind, T.DoubleType):
        return F.lit(NO_SCORE)
    if isinstance(kind, T.LongType):
        return F.lit(NO_COUNT).cast("long")
    return F.lit(NO_TEXT)


_ARROW = {_STR: pa.string(), _LONG: pa.int64(), _DOUBLE: pa.float64(), _INT: pa.int32()}


def rows_to_table(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """A short driver-side list as a table; the schema is explicit, so no rows is fine too.

    Handed over as Arrow, the list is a local table whose size Spark knows, and joins with it
    are planned accordingly. A list handed over row by row has no known size.
    """
    rows = list(rows)
    if any(field.dataType not in _ARROW for field in schema):
        return spark.createDataFrame(rows, schema)  # nested columns
    columns = [
        pa.array([row[i] for row in rows], _ARROW[field.dataType]) for i, field in enumerate(schema)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def empty_like(df: DataFrame) -> DataFrame:
    """The emptied table: same columns, no rows."""
    return df.filter(F.lit(False))
