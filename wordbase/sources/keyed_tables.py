"""Tables laid out by key, for small changes to long tables and for look-ups that read little.

The rows are dealt to folders by a hash of their key. A change reads the folders its keys fall into, and writes those that became
different; Spark replaces them by an overwrite of single partitions, and all other files stay as they are. In a folder rows are
sorted by key and written in short row groups with a bloom filter, so a look-up lists the folders of its keys and, in these, skips row groups.

A change is prepared as a written table first. If a job of it fails, the table has its old rows or, after a failure in the midst of the last step, some
folders of the new ones; running the same change again ends in the same rows. Two changes at the same time must not touch the same folders.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordbase.operators.keyed import as_keys, listed
from wordbase.runtime import stored

BUCKET = "bucket"
SHORT_LIST = 1000  #: keys that are handed to the scan as a list; more are joined
ROW_GROUP = 4 << 20  #: bytes


class KeyedTable(NamedTuple):
    """Where a table is, its columns, its key and the number of folders it is dealt to."""

    path: str
    schema: T.StructType
    key: str
    buckets: int


class Outcome(NamedTuple):
    """How many rows a change added, replaced and removed, and the folders it wrote or deleted."""

    added: int
    changed: int
    gone: int
    buckets: list[int]


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, table: KeyedTable, n: int) -> None:
    """Rows with their bucket, each bucket by one task; ``n`` buckets are expected."""
    parts = min(n, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (
        rows.repartition(max(1, parts), BUCKET)
        .sortWithinPartitions(BUCKET, table.key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", ROW_GROUP)
        .option(f"parquet.bloom.filter.enabled#{table.key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy(BUCKET)
        .parquet(table.path)
    )


def create(rows: DataFrame, path: str, key: str, buckets: int) -> KeyedTable:
    """Lay ``rows`` out as a new table: one row per key, none without.

    ``buckets`` should leave some 100 MB to a folder, and be many times the number of keys that change at once.
    """
    if BUCKET in rows.columns:
        raise ValueError(f"a column is named {BUCKET!r}, as the folders are")
    table = KeyedTable(path, rows.schema, key, buckets)
    _write(rows.where(F.col(key).isNotNull()).withColumn(BUCKET, bucket_of(F.col(key), buckets)), table, buckets)
    return table


def _scan(spark: SparkSession, table: KeyedTable) -> DataFrame:
    there = spark._jvm.org.apache.hadoop.fs.Path(table.path)
    whole = T.StructType([*table.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(table.path)


def read(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return _scan(spark, table).select(*table.schema.names)


def _buckets(keys: DataFrame, table: KeyedTable) -> list[int]:
    """The folders of some keys; no more than the table has."""
    found = keys.where(F.col(table.key).isNotNull()).select(bucket_of(F.col(table.key), table.buckets).alias(BUCKET)).distinct()
    return sorted(r[BUCKET] for r in found.collect())


def look_up(spark: SparkSession, table: KeyedTable, words: DataFrame | list[str]) -> DataFrame:
    """The rows of the given keys (a list, or a table with a column ``word``).

    A short list is part of the scan's filter, which prunes folders by their number and row groups by sorted order and bloom
    filter. A longer one prunes folders and is joined within them.
    """
    scan = _scan(spark, table)
    keys = as_keys(scan, words, table.key)
    short = keys.limit(SHORT_LIST + 1).collect() if isinstance(words, DataFrame) else [(w,) for w in dict.fromkeys(words)]
    if len(short) <= SHORT_LIST:
        names = [r[0] for r in short if r[0] is not None]
        keys = listed(scan, names, table.key)
        found = scan.where(F.col(BUCKET).isin(_buckets(keys, table)) & F.col(table.key).isin(names))
    else:
        found = scan.where(F.col(BUCKET).isin(_buckets(keys, table))).join(keys, table.key, "left_semi")
    return found.select(*table.schema.names)


def change(spark: SparkSession, table: KeyedTable, keys: DataFrame, apply: Callable[[DataFrame], DataFrame]) -> Outcome:
    """Make a change in place. ``keys`` has, in a column named as the key, all keys that may change; ``apply`` turns the rows that share folders with
    them into the rows after the change, as the functions of ``operators.changes`` and ``graph_changes`` do with a whole table.

    Folders whose rows stay the same are not written, so a repeated change writes nothing. A change to keys it did not name is refused.
    """
    touched = _buckets(keys, table)
    if not touched:
        return Outcome(0, 0, 0, [])
    names = table.schema.names
    own = bucket_of(F.col(table.key), table.buckets)
    before = _scan(spark, table).where(F.col(BUCKET).isin(touched))
    stray = F.raise_error(F.concat(F.lit("a key of another folder was changed: "), F.col(table.key)))
    placed = F.when(own.isin(touched), own).otherwise(stray.cast("int"))
    after = stored(apply(before.select(*names)).select(*names).withColumn(BUCKET, placed), "changed")
    sides = before.select("*", F.lit(-1).alias("side")).unionByName(after.select("*", F.lit(1).alias("side")))
    rows = sides.groupBy(BUCKET, *names).agg(F.sum("side").alias("side")).where("side <> 0")
    keyed = rows.groupBy(BUCKET, table.key).agg(F.min("side").alias("low"), F.max("side").alias("high"))
    kinds = {"added": F.col("low") > 0, "changed": (F.col("low") < 0) & (F.col("high") > 0), "gone": F.col("high") < 0}
    by_bucket = keyed.groupBy(BUCKET).agg(*(F.count_if(is_kind).alias(kind) for kind, is_kind in kinds.items())).collect()
    written = sorted(r[BUCKET] for r in by_bucket)
    if written:
        new = after.where(F.col(BUCKET).isin(written))
        left = {r[BUCKET] for r in new.select(BUCKET).distinct().collect()}
        if left:
            _write(new, table, len(left))
        for bucket in set(written) - left:  # an overwrite does not reach folders that have no rows now
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table.path}/{BUCKET}={bucket}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return Outcome(*(sum(r[c] for r in by_bucket) for c in ("added", "changed", "gone")), written)
