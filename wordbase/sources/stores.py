"""Scans, saves and loads of the lexicon and graph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordbase.functions.parse import key_matches, word_key
from wordbase.schemas import EDGE, FLAT, NODE


def keyed_scan(lexicon: DataFrame, pattern: str = "*") -> DataFrame:
    """The flat lexicon with its key column first: eleven columns."""
    scan = lexicon.select(word_key(F.col("word")).alias("key"), *FLAT.names)
    return scan if pattern == "*" else scan.filter(key_matches(F.col("key"), pattern))


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Write both tables; edges are laid out by relation so that reading one prunes the rest."""
    nodes.select(*NODE.names).write.mode("overwrite").parquet(f"{path}/nodes")
    edges.select(*EDGE.names).write.mode("overwrite").partitionBy("rel").parquet(f"{path}/edges")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    nodes = spark.read.schema(NODE).parquet(f"{path}/nodes")
    edges = spark.read.schema(EDGE).parquet(f"{path}/edges").select(*EDGE.names)
    return nodes, edges
