"""Exact copies by a tree merge of sorted digest runs.

Every row becomes (digest, smallest identifier, count). The rows of one leaf form a run: sorted by
digest, one entry for each text. In round ``r`` of the tree, the 16 nodes whose numbers differ in digit ``r`` only
exchange their runs by digit ``r`` of the second hash, and each merges what it got; after the last
round every node holds one part of the digest space, so no node ever holds all of it. The number of leaves
follows the number of shuffle partitions. A group of copies shrinks to one entry per leaf before the
first exchange, and answers go back the same way, leaf by leaf, so no join meets a hot digest.

Entries agree only if SHA-256, length in bytes and a second hash agree, at every level.

Defined results: a null text is an empty one; all rows with empty texts are copies of each other. A row with
a null id stays only if all ids of its group are null. Of rows with equal id and equal text, one stays.
An empty table gives no rows. Other columns of the table are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordbase.llm.common import id_and_text, shuffle_partitions
from wordbase.runtime import stored

KEY = ["digest", "n_bytes", "check"]
BITS = 4  #: of a digit: 16 runs are merged at once


def _leaf_bits(df: DataFrame) -> int:
    """Bits of a leaf's number: as many leaves as shuffle partitions or more, in whole digits."""
    return BITS * max(1, -(-(shuffle_partitions(df.sparkSession) - 1).bit_length() // BITS))


def _keyed(docs: DataFrame) -> DataFrame:
    row = F.monotonically_increasing_id()
    return id_and_text(docs).select(
        row.alias("row"),
        F.xxhash64(row).bitwiseAND((1 << _leaf_bits(docs)) - 1).alias("leaf"),
        "doc_id",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.xxhash64("text").alias("check"),
    )


def _digit(number: str, r: int):
    return F.shiftright(number, BITS * r).bitwiseAND((1 << BITS) - 1)


def _merge(runs: DataFrame) -> DataFrame:
    return runs.groupBy("node", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def _leaf_runs(rows: DataFrame, keep: str) -> DataFrame:
    rank = F.col("doc_id") if keep == "smallest" else F.bitwise_not("doc_id")
    # nulls come last, and equal ids are told apart by the row
    best = F.struct(F.isnull("doc_id").alias("null"), rank.alias("rank"), "row", "doc_id")
    return _merge(rows.select(F.col("leaf").alias("node"), *KEY, best.alias("best"), F.lit(1).cast("long").alias("n")))


def _merged(runs: DataFrame) -> DataFrame:
    """All rounds of the tree: a node ends with the texts whose second hash ends in its number."""
    bits = _leaf_bits(runs)
    for r in range(bits // BITS):
        to = F.col("node") - F.shiftleft(_digit("node", r), BITS * r) + F.shiftleft(_digit("check", r), BITS * r)
        exchanged = runs.withColumn("node", to).repartition(1 << bits, "node")
        runs = _merge(exchanged.sortWithinPartitions("node", *KEY))
    return runs


def exact_groups(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says whether the row with the smallest or the largest id of a group stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    rows = stored(_keyed(docs), "digests")
    runs = stored(_leaf_runs(rows, keep), "runs")
    merged = _merged(runs).select(
        *KEY, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), F.col("n").alias("group_size")
    )
    answers = runs.select(F.col("node").alias("leaf"), *KEY).join(merged, KEY)
    return rows.join(answers, ["leaf", *KEY]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; texts are moved once."""

    def key(doc_id, digest):
        return F.concat_ws(":", doc_id.cast("string"), digest).alias("__key")

    stay = exact_groups(docs, keep).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")))
    marked = docs.select("*", key(docs["doc_id"], F.sha2(F.coalesce(docs["text"], F.lit("")), 256)))
    # rows that repeat id and text share a key; the join has brought them together
    turn = F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(1)))
    return marked.join(stay, "__key").withColumn("__turn", turn).where("__turn = 1").drop("__key", "__turn")
