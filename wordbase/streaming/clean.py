"""The cleaning stream: title messages in, word counts per message out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wordbase.operators.tokens import token_rows, word_counts
from wordbase.schemas import MESSAGE
from wordbase.sources.articles import found_texts, of_categories
from wordbase.sources.messages import parsed_messages, split_parsed
from wordbase.sources.runs import CLEANED, run_path

MESSAGE_COUNTS = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("word", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)


def category_of(message_id: Column) -> Column:
    """The category in the id of a title message; null where it has none."""
    pattern = "(?s)^(.*)/[0-9]+$"
    return F.when(message_id.rlike(pattern), F.regexp_extract(message_id, pattern, 1))


def read_messages(spark: SparkSession, source: str, format: str = "json", **options) -> DataFrame:
    """The message stream from its beginning: a folder, or a topic with ``format="kafka"``.

    The category of a message comes from its column, or from the key of a topic's message.
    Progress is kept in the checkpoint of the query that reads it.
    """
    if format == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("subscribe", source)
            .option("startingOffsets", "earliest")
            .options(**options)
            .load()
        )
        place = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
        category = category_of(F.col("key").cast("string"))
        return raw.select(place.alias("message_id"), category.alias("category"), F.col("value").cast("string").alias("value"))
    return spark.readStream.schema(MESSAGE).options(**options).format(format).load(source)


def message_word_counts(titles: DataFrame, articles: DataFrame, unique: bool = False) -> DataFrame:
    """Word counts of each message's articles; counts of different messages are kept apart."""
    # a title without a text has no words, so the titles that have one are enough
    texts = found_texts(titles, of_categories(articles, titles), unique)
    return word_counts(token_rows(texts, "message_id"), "message_id")


def clean_messages(
    messages: DataFrame,
    articles: DataFrame,
    root: str,
    stamp: str,
    owner: str,
    checkpoint: str,
    unique: bool = False,
    available_now: bool = False,
) -> StreamingQuery:
    """Start cleaning: folders of titles, counts (headed CSV) and rejects per micro-batch.

    ``stamp`` names the run; a restart passes the same one. Folders are named by batch and
    overwritten, so a batch that is repeated after a failure leaves its counts once. Where ``articles`` has a
    category, articles are named by category and title, and only those of the batch's categories are read.
    """
    run = run_path(root, CLEANED, stamp, owner)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        place = {part: f"{run}/{part}/batch_id={batch_id}" for part in ("titles", "counts", "rejects")}
        keep = ["message_id", *(c for c in ("category",) if c in batch.columns and c in articles.columns)]
        # the batch is read once; a written table also has a known size: a short title list is broadcast to
        # the articles, which are then not shuffled batch after batch
        parsed = parsed_messages(batch, *keep)
        parsed.write.mode("overwrite").parquet(place["titles"])
        titles, rejects = split_parsed(batch.sparkSession.read.schema(parsed.schema).parquet(place["titles"]), *keep)
        rejects.select("message_id", "value", "reason").write.mode("overwrite").option("header", True).csv(place["rejects"])
        counts = message_word_counts(titles, articles, unique)
        counts.write.mode("overwrite").option("header", True).csv(place["counts"])

    writer = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def cleaned_messages(spark: SparkSession, root: str, stamp: str, owner: str) -> DataFrame:
    """``message_id, word, count`` of all batches of a run."""
    folder = f"{run_path(root, CLEANED, stamp, owner)}/counts"
    schema = T.StructType([*MESSAGE_COUNTS.fields]).add("batch_id", T.LongType())
    return (
        spark.read.schema(schema).option("header", True).csv(folder).select(*MESSAGE_COUNTS.names)
    )
