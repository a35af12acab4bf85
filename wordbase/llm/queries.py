"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordbase.llm import chat, decontaminate, exact_dedup, language, lattice, line_dedup, packing, phrases, pii, secret_scan, simhash, token_counts, vector_codes
from wordbase.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SUBWORDS = public_tokenizers.path("piece_bpe_32k.model")


def _fold(modulus: int):
    """Whether a document is held out: crc32 of its id as text leaves 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 1, F.lit(False))


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks in control strings, formatted and read back."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table.union(more).withColumn("parts", chat.text_part(F.col("text")))
    return chat.conversation_digests(chat.format_conversations(turns))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(documents(spark, sf_dir))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(documents(spark, sf_dir), words=3, radius=3)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of benchmark items, with the items; clean documents have no row."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(documents(spark, sf_dir), benchmark)
    return found.select("doc_id", "item_id", "found", "share", F.lit(True).alias("contaminated"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs.where(~_fold(3)))
    guess = language.language(docs, model).alias("guess")
    return docs.select("doc_id", _fold(3).alias("held_out"), guess).select(
        "doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), "guess.score"
    )


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir), keep="largest")


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir), threshold=1)


@query
def op8_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.document_scores(documents(spark, sf_dir), _fold(5), SUBWORDS)


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), VOCABULARY, max_len=2048, closing_id=1)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.piece_counts(documents(spark, sf_dir), VOCABULARY)


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's collocations of two and three words."""
    return phrases.collocations(documents(spark, sf_dir))


@query
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, each content scanned once, by a ledger that begins empty."""
    return secret_scan.secret_report(documents(spark, sf_dir))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as four bytes by product quantisation, 256 entries for each quarter."""
    return vector_codes.code_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
