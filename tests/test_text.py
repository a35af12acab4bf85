from __future__ import annotations

import re

from pyspark.sql import functions as F

from wordbase.functions.text import capitalised, percent_text, words
from wordbase.operators.tokens import token_rows, word_counts

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


def tokens_of(spark, text):
    return spark.createDataFrame([(text,)], "text string").select(words(F.col("text"))).first()[0]


def test_words_are_whole_runs_of_ascii_letters(spark):
    assert tokens_of(spark, "réeau a_b c1 Don't X ab cd") == ["don", "ab", "cd"]
    assert tokens_of(spark, "") == []
    assert tokens_of(spark, "naïve co-op x2 ²ab ab² Ⅷab don_t THE The") == ["co", "op", "the", "the"]


def test_words_agree_with_python_on_whole_documents(spark):
    df = spark.read.parquet(DOCUMENTS)
    ours = df.select("text", words(F.col("text")).alias("w")).collect()
    pattern = re.compile(r"\b[a-zA-Z]{2,}\b")
    for row in ours:
        assert row.w == pattern.findall(row.text.lower())


def test_long_runs_are_read_whole(spark):
    run = "ab" * 200_000
    assert tokens_of(spark, run) == [run]
    assert tokens_of(spark, run + "é") == []


def test_texts_without_words_vanish_and_repeats_stay(spark):
    df = spark.createDataFrame([(1, "ab ab"), (2, "1 2"), (3, None)], "doc_id int, text string")
    rows = token_rows(df, "doc_id")
    assert [tuple(r) for r in rows.collect()] == [(1, "ab"), (1, "ab")]
    assert [tuple(r) for r in word_counts(rows).collect()] == [("ab", 2)]


def test_labels_and_percents(spark):
    row = spark.range(1).select(
        capitalised(F.lit("sentiment_SCORES of x")).alias("label"),
        *(percent_text(F.lit(v)).alias(f"p{i}") for i, v in enumerate((0.125, 0.135, 100.0, 12.5))),
    ).first()
    assert row.label == "Sentiment_scores of x"
    assert [row[f"p{i}"] for i in range(4)] == [f"{v:.2f}%" for v in (0.125, 0.135, 100.0, 12.5)]
