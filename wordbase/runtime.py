"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


_written: dict[str, list[str]] = {}  # paths by application
_named: dict[str, list[str]] = {}  # tables of the catalog by application


def _shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"wordbase-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for one written table."""
    path = f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder, for inputs that are read repeatedly.

    The table survives lost executors, and its known size lets Spark choose joins by fact
    instead of by an estimate through explodes and aggregates.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """``df`` written once, dealt to buckets by its keys and sorted by them in each: joins on all of the keys do not shuffle it.

    Spark knows the layout by the catalog, so the table has a name there; its files are in the shared folder.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    dealt.option("path", scratch_path(df.sparkSession, name)).format("parquet").saveAsTable(table)
    _named.setdefault(df.sparkSession.sparkContext.applicationId, []).append(table)
    return df.sparkSession.table(table)


def clear_stored(spark: SparkSession) -> int:
    """Delete what this session has written with ``scratch_path``, ``stored`` and ``stored_in_buckets``; returns how many paths that were.

    The caller runs it when all results are read: until then they are read from these tables.
    """
    for table in _named.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)
    return len(paths)
