from __future__ import annotations

import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wordbase.operators.tokens import token_rows, word_counts
from wordbase.sources.articles import found_texts, lay_out_articles
from wordbase.sources.messages import title_messages, write_messages
from wordbase.streaming import clean
from wordbase.streaming.clean import clean_messages, cleaned_messages, read_messages

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"
STAMP, OWNER = "12.12.2024_21.08.30", "me"


def run(spark, root, articles):
    clean_messages(
        read_messages(spark, f"{root}/in"), articles, root, STAMP, OWNER, f"{root}/checkpoint",
        available_now=True,
    ).awaitTermination()
    return cleaned_messages(spark, root, STAMP, OWNER)


def test_stream_equals_batch_and_a_restart_adds_nothing(spark, tmp_path):
    root = str(tmp_path)
    documents = spark.read.parquet(DOCUMENTS)
    articles = documents.selectExpr("source as category", "cast(doc_id as string) as title", "text")
    write_messages(title_messages(articles), f"{root}/in")
    streamed = run(spark, root, articles)
    batch = word_counts(token_rows(documents, "source"), "source")
    key = "replace(message_id, '/0') as source"
    assert sorted(streamed.selectExpr(key, "word", "count").collect()) == sorted(batch.collect())
    before = streamed.count()
    assert run(spark, root, articles).count() == before


def test_messages_are_counted_apart_and_bad_ones_set_aside(spark, tmp_path):
    root = str(tmp_path)
    articles = spark.createDataFrame([("1", "ab ab cd"), ("2", "ab")], "title string, text string")
    sent = [("m1", '["1", "2", "nowhere"]'), ("m2", '["2"]'), ("m3", "{oops"), ("m4", "[]")]
    write_messages(spark.createDataFrame(sent, "message_id string, value string"), f"{root}/in")
    got = run(spark, root, articles)
    assert sorted(tuple(r) for r in got.collect()) == [("m1", "ab", 3), ("m1", "cd", 1), ("m2", "ab", 1)]
    rejects = spark.read.option("header", True).csv(
        f"{root}/cleaned/run_ts={STAMP}/owner={OWNER}/rejects"
    )
    assert [r.message_id for r in rejects.collect()] == ["m3"]


def test_a_second_batch_adds_its_messages(spark, tmp_path):
    root = str(tmp_path)
    articles = spark.createDataFrame([("1", "ab"), ("2", "cd")], "title string, text string")
    for number in ("1", "2"):
        sent = spark.createDataFrame([(number, f'["{number}"]')], "message_id string, value string")
        write_messages(sent, f"{root}/in")
        got = run(spark, root, articles)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "ab", 1), ("2", "cd", 1)]


# --- recovery --------------------------------------------------------------

WORDS = [f"{a}{b}{c}" for a in "abcdef" for b in "ghij" for c in "klm"]


def several_messages(spark, root, n=6):
    """One file a message, each about one article; the counts they should give."""
    articles = [(str(i), " ".join(WORDS[(i * 7 + k) % len(WORDS)] for k in range(20 + i))) for i in range(n)]
    for title, _ in articles:
        write_messages(spark.createDataFrame([(f"m{title}", f'["{title}"]')], "message_id string, value string").coalesce(1), f"{root}/in")
    table = spark.createDataFrame(articles, "title string, text string")
    want = [(f"m{t}", w, text.split().count(w)) for t, text in articles for w in set(text.split())]
    return table, sorted(want)


def start(spark, root, articles):
    """A stream that takes one file a batch."""
    source = read_messages(spark, f"{root}/in", maxFilesPerTrigger=1)
    return clean_messages(source, articles, root, STAMP, OWNER, f"{root}/checkpoint", available_now=True)


def counted(spark, root):
    return sorted(tuple(r) for r in cleaned_messages(spark, root, STAMP, OWNER).collect())


@pytest.mark.parametrize("moment", ["before its counts are planned", "while its counts are written"])
def test_a_batch_that_fails_is_made_again(spark, tmp_path, monkeypatch, moment):
    """The third batch fails; the stream is started again on its checkpoint and goes on from there."""
    root = str(tmp_path)
    articles, want = several_messages(spark, root)
    plain, batches = clean.message_word_counts, []

    def failing(titles, *more):
        batches.append(1)
        if len(batches) != 3:
            return plain(titles, *more)
        if moment.startswith("before"):
            raise RuntimeError("injected")
        # some tasks have written their rows when another one fails
        counts = plain(titles, *more).repartition(4)
        return counts.withColumn("count", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("injected")).cast("long")).otherwise(F.col("count")))

    monkeypatch.setattr(clean, "message_word_counts", failing)
    with pytest.raises(StreamingQueryException, match="injected"):
        start(spark, root, articles).awaitTermination()
    done = {m for m, _, _ in counted(spark, root)}
    assert len(done) == 2 and [r for r in want if r[0] in done] == counted(spark, root)
    start(spark, root, articles).awaitTermination()
    assert counted(spark, root) == want and len(batches) == 7
    start(spark, root, articles).awaitTermination()
    assert counted(spark, root) == want and len(batches) == 7


def test_a_batch_that_was_not_committed_counts_once(spark, tmp_path):
    """The driver is lost after the last batch is written and before it is committed: the batch is repeated, its folder replaced."""
    root = str(tmp_path)
    articles, want = several_messages(spark, root)
    start(spark, root, articles).awaitTermination()
    assert counted(spark, root) == want
    commits = sorted((p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    assert len(commits) == 6
    for name in (commits[-1].name, f".{commits[-1].name}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    start(spark, root, articles).awaitTermination()
    assert counted(spark, root) == want
    write_messages(spark.createDataFrame([("late", '["0"]')], "message_id string, value string"), f"{root}/in")
    start(spark, root, articles).awaitTermination()
    assert {m for m, _, _ in counted(spark, root)} == {m for m, _, _ in want} | {"late"}


def test_a_batch_shuffles_titles_only(spark, tmp_path, settings):
    """Articles in buckets are neither shuffled nor sorted for a batch, and a hot title is joined in pieces."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    pages = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 7)).alias("category"), F.concat(F.lit("t"), F.col("id")).alias("title"), F.concat(F.lit("text of "), F.col("id")).alias("text")
    )
    laid_out = lay_out_articles(pages, 8)
    titles = pages.where("title LIKE '%3'").select(F.concat(F.lit("m"), F.col("title")).alias("message_id"), "category", "title")
    counts = clean.message_word_counts(titles, laid_out, True)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above, depth = [], re.search(r"[A-Z(*]", lines[at]).start()
    for line in reversed(lines[:at]):
        here = re.search(r"[A-Z(*]", line).start() if re.search(r"[A-Z(*]", line) else 0
        if here < depth:
            above.append(line)
            depth = here
    below_join = above[: next(i for i, line in enumerate(above) if "Join" in line)]
    assert "Exchange hashpartitioning" in plan and not [line for line in below_join if "Exchange" in line], plan
    want = clean.message_word_counts(titles, pages, True)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, want.collect()))
    crowd = spark.range(4000).select(F.concat(F.lit("m"), F.col("id") % 50).alias("message_id"), F.lit("c1").alias("category"), F.lit("t1").alias("title"))
    both = titles.unionByName(crowd)
    assert sorted(map(tuple, found_texts(both, laid_out, True).collect())) == sorted(map(tuple, found_texts(both, pages, True).collect()))
