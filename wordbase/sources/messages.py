"""Title lists as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.operators.keyed import spread_join
from wordbase.runtime import stored
from wordbase.schemas import TITLES
from wordbase.sources.articles import CATEGORY_KEY, with_category_key

# A title listing call returns at most this many titles, and one call makes one message.
TITLES_PER_MESSAGE = 500


def title_messages(titles: DataFrame, titles_per_message: int = TITLES_PER_MESSAGE) -> DataFrame:
    """Messages ``(message_id, category, part, parts, value)``, each value a JSON array of titles.

    A category of up to ``titles_per_message`` titles is one message. A larger one is
    hashed over as many messages as it needs, about that many titles each, and every message says which of
    how many it is, so that a consumer can put the counts of a category together. A title that repeats goes
    to one message after the other. The split depends on the titles alone, so a retried task repeats it.
    Titles without a category are a category of their own, whose ``message_id`` is the part alone.
    """
    sizes = stored(titles.groupBy("category").agg(F.count("*").alias("size")), "category_sizes")
    parts = F.greatest(F.ceil(F.col("size") / F.lit(titles_per_message)), F.lit(1)).cast("int")
    counted = titles.groupBy("category", "title").agg(F.count("*").alias("times"))
    keyed = with_category_key(sizes)
    parted = keyed.select(*CATEGORY_KEY, parts.alias("parts"))
    sized = spread_join(with_category_key(counted), parted, CATEGORY_KEY, sizes_of=keyed, size="size")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy")
    part = F.pmod(F.shiftright(F.xxhash64("title"), 1) + F.col("copy"), F.col("parts")).cast("int")
    return (
        sized.select("category", "title", "parts", copies)
        .groupBy("category", part.alias("part"), "parts")
        .agg(F.to_json(F.sort_array(F.collect_list("title"))).alias("value"))
        .select(
            F.concat_ws("/", "category", F.col("part").cast("string")).alias("message_id"),
            "category",
            "part",
            "parts",
            "value",
        )
    )


def write_messages(messages: DataFrame, target: str, format: str = "json", **options) -> None:
    """Publish messages to a folder, or to a topic with ``format="kafka"``.

    For Kafka, ``target`` is the topic and ``options`` carry ``kafka.bootstrap.servers``; the
    connector has to be on the cluster.
    """
    if format == "kafka":
        keyed = messages.select(F.col("message_id").alias("key"), "value")
        keyed.write.format("kafka").option("topic", target).options(**options).save()
    else:
        messages.write.format(format).mode("append").options(**options).save(target)


def parsed_messages(messages: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, the value as text, and its titles; null titles: no JSON array of titles."""
    value = F.col("value").cast("string")
    return messages.select(*keep, value.alias("value"), F.from_json(value, TITLES).alias("titles"))


def split_parsed(parsed: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """One row per title of ``parsed_messages``, and the messages that have no list."""
    titles = parsed.select(*keep, F.explode("titles").alias("title"))
    rejects = parsed.filter(F.col("titles").isNull())
    return titles, rejects.select(*keep, "value", F.lit("not a JSON array").alias("reason"))


def decode_titles(messages: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """One row per title, and the messages that are no JSON array of titles."""
    return split_parsed(parsed_messages(messages, *keep), *keep)
