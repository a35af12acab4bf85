"""Headed CSV tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordbase.functions.parse import safe_double
from wordbase.runtime import stored
from wordbase.schemas import NODE

FILE_ORDER = "seq"
_BAD, _REASON = "__bad_record", "__reason"


def _typed(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DoubleType):
        return safe_double(column)
    return column if isinstance(kind, T.StringType) else column.try_cast(kind)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Read a headed CSV by column name.

    Only the header line is looked at up front: columns arrive as text and the declared
    types are applied as part of the plan, so there is no inference pass over the data.
    Declared columns the file lacks are left out, other columns stay text.
    """
    raw = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    kinds = {field.name: field.dataType for field in schema}
    return raw.select(
        *(
            _typed(F.col(f"`{name}`"), kinds.get(name, T.StringType())).alias(name)
            for name in raw.columns
        )
    )


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV that are as declared, and the others: ``file, block, row`` (the place in the block of the file that a task reads),
    ``record`` and ``reason``.

    A record is refused if it has more or fewer fields than ``schema``, or if a field that is not blank is no value of its type; the first such field is
    named. Fields are those of the schema in order. Nothing is dropped silently: each record is in one of both tables.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_BAD, T.StringType())])
    raw = (
        spark.read.schema(text).option("header", header).option("escape", '"').option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD).option("columnPruning", False).csv(path)
    )
    typed = [_typed(F.col(f"`{f.name}`"), f.dataType) for f in schema]
    no_value = [
        F.when(F.col(f"`{f.name}`").isNotNull() & value.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
        for f, value in zip(schema, typed, strict=True)
        if not isinstance(f.dataType, T.StringType)
    ]
    reason = F.coalesce(F.when(F.col(_BAD).isNotNull(), "wrong number of fields"), *no_value, F.lit(None))
    judged = raw.withColumn(_REASON, reason)
    fields = F.to_csv(F.struct(*(F.col(f"`{f.name}`") for f in schema)))
    rejects = judged.where(F.col(_REASON).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"), F.coalesce(_BAD, fields).alias("record"), F.col(_REASON).alias("reason"),
    )
    good = judged.where(F.col(_REASON).isNull()).select(*(value.alias(f.name) for f, value in zip(schema, typed, strict=True)))
    return good, rejects


def _pieces(batches: Iterator[pa.RecordBatch], inside_at: set[tuple[str, int]], header: bool) -> Iterator[pa.RecordBatch]:
    """Records of lines that come in order, block by block: whole ones, and the parts of those that reach over the end of a block."""
    place, inside, parts, headless, first = None, False, [], False, False
    out: list[tuple] = []

    def part(end_of_block: bool) -> None:
        """What is held is a record, or a part of one: with its start (1), or without (0)."""
        nonlocal parts, headless, first
        if parts:
            text = "\n".join(parts)
            is_part = headless or end_of_block
            if not is_part:
                text = text.removesuffix("\r")
            if is_part or text and not first:
                out.append((*place, None if not is_part else 0 if headless else 1, text))
            if not is_part and text:
                first = False
        parts, headless = [], False

    for batch in batches:
        files, blocks = batch["file"].to_pylist(), batch["block"].to_pylist()
        odd = (pc.count_substring(batch["value"], '"').to_numpy(zero_copy_only=False) % 2).tolist()
        for file, block, line, is_odd in zip(files, blocks, batch["value"].to_pylist(), odd, strict=True):
            if (file, block) != place:
                part(inside)
                place = file, block
                inside = headless = place in inside_at
                first = header and block == 0
            parts.append(line)
            inside ^= bool(is_odd)
            if not inside:
                part(False)
            if len(out) >= 10_000:
                yield _piece_batch(out)
                out = []
    part(inside)
    yield _piece_batch(out)


_PIECE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("starts", pa.int32()), ("record", pa.string())])


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_PIECE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE, strict=True)], schema=_PIECE)


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The records of CSV files as text in a column ``record``, line breaks in quotes included; one file is read by many tasks.

    A block that a task reads begins inside quotes if the blocks before it hold an odd number of them. So quotes are counted by block first, which
    shuffles a number for each block, and their prefix sums tell where each block begins: one flag for each, as many as the driver has planned
    reads for. Then each task puts its lines together on its own. Only parts of records that reach over the end of a block are shuffled,
    to be joined in order.

    Quotes inside a quoted field are doubled. The first record of each file is left out as its ``header``; it must not be longer than a block. Empty records are left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = F.coalesce(F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("file", "block", (before % 2).alias("inside")).where("inside = 1")
    inside_at = spark.sparkContext.broadcast({(r["file"], r["block"]) for r in starts.collect()})
    made = lines.mapInArrow(lambda batches: _pieces(batches, inside_at.value, header), "file string, block long, starts int, record string")
    made = stored(made, "records")  # files are read once for their quotes and once for their records
    whole = made.where("starts IS NULL").select("record")
    parts = made.where("starts IS NOT NULL")
    # a part without a start comes at the beginning of its block, one with a start at the end
    number = F.sum("starts").over(Window.partitionBy("file").orderBy("block", "starts").rowsBetween(Window.unboundedPreceding, 0))
    joined = parts.withColumn("number", number).groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "starts", "record"))).alias("parts"))
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda x: x["record"]), "\n"), "\r$", "")
    return whole.union(joined.select(text.alias("record")).where("record <> ''"))


def read_long_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The rows of a CSV whose quoted fields may hold line breaks, like ``read_csv`` with ``multi_line``, but a long file is read by many tasks."""
    plain = spark.read.option("header", header).option("escape", '"')
    names = plain.csv(path).columns if header else schema.names
    kinds = {field.name: field.dataType for field in schema}
    text = ", ".join(f"`{name}` string" for name in names)
    fields = F.from_csv("record", text, {"escape": '"', "multiLine": "true"}).alias("fields")
    rows = csv_records(spark, path, header).select(fields)
    return rows.select(*(_typed(F.col(f"fields.`{name}`"), kinds.get(name, T.StringType())).alias(name) for name in names))


def write_csv(df: DataFrame, path: str) -> None:
    """Write a headed CSV, replacing what was there. Line breaks stay, in quotes; quotes are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_node_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Node rows of a ``word, POS, sentiment, sentiment_score, meaning`` CSV.

    Blank text stays blank, a blank or bad score becomes null, and ``bad_score`` marks the
    bad ones. ``seq`` is the place of the row: file, then position in the file. With ``multi_line``, quoted
    fields may hold line breaks; each file is then read by one task.
    """
    raw = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    score = F.col("sentiment_score")
    return raw.select(
        F.col("word").alias("name"),
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("POS", "sentiment")),
        safe_double(score).alias("sentiment_score"),
        F.coalesce(F.col("meaning"), F.lit("")).alias("meaning"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(FILE_ORDER),
        (score.isNotNull() & safe_double(score).isNull()).alias("bad_score"),
    ).select(*NODE.names, FILE_ORDER, "bad_score")
