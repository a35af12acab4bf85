"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordbase.llm import decontaminate, exact_dedup, language, packing, simhash
from wordbase.llm.common import documents
from wordbase.llm.queries import VOCABULARY
from wordbase.runtime import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that the labels teach go: those without a letter, and those with a low score."""
    return language.drop_unknown(docs, language.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints within 3 bits, the one with the smallest id stays."""
    return simhash.drop_near_copies(docs, words=3, radius=3)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, as pieces of sequences of 2048 ids."""
    return packing.pack_documents(docs, VOCABULARY, max_len=2048, closing_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("decontamination", clean_of_benchmarks),
    ("packing", packed),
]

#: SQL cannot say language ID, fingerprints, templates and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
