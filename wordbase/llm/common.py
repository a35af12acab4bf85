"""What several operators of this package need."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordbase.runtime import stored


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns nearly every operator reads; a null text counts as empty."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column without nulls."""
    return column.cast(pa.large_binary()).to_pylist()


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few texts at a time are Python objects."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def arrow_rows(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(rows, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are in ``gone`` (doc_id, check: the hash of the text).

    ``gone`` is written first, so that Spark knows its size and moves the texts only if it is long.
    """
    gone = stored(gone.select(F.col("doc_id").alias("__id"), F.col("check").alias("__check")).distinct(), "gone")
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["__check"])
    return docs.join(gone, same, "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large stars and small stars.

    ``edges`` has long columns ``a`` and ``b``; the result has one row (``node``, ``root``) for
    every node of an edge between different nodes, roots included. Each step hangs the
    neighbours of a node to the smallest of them, so no neighbourhood is ever gathered: a
    minimum per node (combined before the shuffle) is joined back to the edges. The number of
    steps grows with the logarithm of the diameter; each is a written table.
    """
    spark = edges.sparkSession
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = stored(large, "links")
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        hung = large.join(down, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        pairs = stored(hung.union(down.select("a", F.col("low").alias("b"))).distinct(), "links")
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
