"""Inputs of the registered queries, derived by rule from the given tables.

The tables hold invented prose without part of speech, sentiment or relations, so these are
made by plain rules over whole tables. Each has a twin in ``oracles.VIEWS``.

* ``documents`` is the corpus the lexicon is counted from, its ``source`` the category.
* ``conversations`` is a second, later batch: new words, corrections and patches come from it,
  and the share of a word in user turns stands in for its sentiment.
* ``benchmark`` gives the word list that is looked up.

An ``Inputs`` object serves one query. Tables the query reads several times are asked for with
``keep``: they are written once to the shared folder, so the corpus is scanned once.
"""

from __future__ import annotations

from functools import cached_property, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordbase.functions.parse import mirror_key
from wordbase.operators.keyed import matching
from wordbase.operators.lookups import node_json
from wordbase.operators.records import append_records, build_lexicon, shape_records
from wordbase.operators.sentiment import score_sentiment
from wordbase.operators.tokens import token_rows, word_counts
from wordbase.runtime import stored
from wordbase.schemas import EDGE

# The given tables the queries read; declared, so that no file is opened to plan a query
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
    "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string",
}

# Fixed values of the rules
NOUN_ENDINGS = ("tion", "ment")
ADVERB_ENDINGS = ("ly",)
VERB_ENDINGS = ("ing", "ed")
ADJECTIVE_ENDINGS = ("able", "ble", "less", "ful")
ENDINGS = NOUN_ENDINGS + ADVERB_ENDINGS + VERB_ENDINGS + ADJECTIVE_ENDINGS
NEGATIONS = ("un", "in", "non")
FUNCTION_WORD_LENGTH = 3
# A list of words as a caller gives it, repeats and unknown words among them
ASKED = ["the", "that", "tion", "die", "und", "que", "les", "thing", "the", "nosuchword"]


def _ends(word: Column, endings) -> Column:
    return word.rlike(f"({'|'.join(endings)})$")


def pos_rule(word: Column) -> Column:
    return (
        F.when(_ends(word, NOUN_ENDINGS), "noun")
        .when(_ends(word, ADVERB_ENDINGS), "adverb")
        .when(_ends(word, VERB_ENDINGS), "verb")
        .when(_ends(word, ADJECTIVE_ENDINGS), "adjective")
        .when(F.length(word) <= FUNCTION_WORD_LENGTH, "function")
    )


def _user_share() -> tuple[Column, Column]:
    raw = F.col("user_count") / F.col("count")
    return (
        F.when(raw >= 0.5, "positive").otherwise("negative").alias("label"),
        F.greatest(raw, 1 - raw).alias("score"),
    )


def stems(words: DataFrame) -> DataFrame:
    """``word, ending, stem`` for every fixed ending of a word that leaves two letters."""
    word, ending = F.col("word"), F.col("ending")
    long_enough = F.filter(
        F.array(*(F.lit(e) for e in ENDINGS)),
        lambda e: F.endswith(word, e) & (F.length(word) >= F.length(e) + 2),
    )
    return words.select("word", F.explode(long_enough).alias("ending")).select(
        "word", "ending", F.left(word, F.length(word) - F.length(ending)).alias("stem")
    )


def _relation_text(ending: Column) -> Column:
    return (
        F.when(ending.isin(*NOUN_ENDINGS), " synonym ")
        .when(ending.isin(*VERB_ENDINGS), "\tHyponym_Of\n")
        .when(ending.isin(*ADVERB_ENDINGS), "related")
        .otherwise("HOLONYM_OF")
    )


def view(build):
    """A derived table, planned once per ``Inputs`` and written down if it is to be kept."""

    @wraps(build)
    def planned(self) -> DataFrame:
        df = build(self)
        return stored(df, build.__name__) if build.__name__ in self.keep else df

    return cached_property(planned)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, *keep: str):
        self.spark, self.sf_dir, self.keep = spark, sf_dir, keep

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def documents(self, *columns: str) -> DataFrame:
        """Documents with the named columns, the key first."""
        return self.table("documents").select("doc_id", *columns)

    @view
    def counts(self) -> DataFrame:
        return word_counts(token_rows(self.documents("text")))

    @view
    def batch_counts(self) -> DataFrame:
        """Words of the second batch: ``word, count, user_count``."""
        turns = self.table("conversations").select("role", "text")
        return (
            token_rows(turns, "role")
            .groupBy("word")
            .agg(F.count("*").alias("count"), F.count_if(F.col("role") == "user").alias("user_count"))
        )

    @view
    def word_list(self) -> DataFrame:
        return token_rows(self.table("benchmark"))

    @view
    def scores(self) -> DataFrame:
        """``word, label, score``: the share of user turns, read as a sentiment."""
        return self.batch_counts.select("word", *_user_share())

    @view
    def scored(self) -> DataFrame:
        return score_sentiment(self.counts, self.scores)

    @view
    def batch_scored(self) -> DataFrame:
        # the batch holds the figures its scores are made of, so no join is needed
        return score_sentiment(self.batch_counts, lambda word: F.struct(*_user_share()))

    @view
    def completed_rows(self) -> DataFrame:
        """Completed annotation rows of the corpus."""
        word = F.col("word")
        return self.scored.select(
            "word",
            "count",
            "sentiment",
            "sentiment_score",
            *(F.lit("-").alias(c) for c in ("synonym", "antonyms", "hypernyms", "meronyms")),
            F.concat(F.lit("m_"), word).alias("meaning"),
            pos_rule(word).alias("POS"),
        )

    @view
    def raw_rows(self) -> DataFrame:
        """The corpus rows as a careless export has them: counts as text, some of them bad."""
        word = F.col("word")
        dirty = (
            F.when(word.endswith("x"), "12.5")
            .when(word.endswith("q"), "bad")
            .when(word.endswith("v"), "count")
            .when(word.endswith("z"), F.lit(None))
            .otherwise(F.col("count").cast("string"))
        )
        return self.completed_rows.withColumn("count", dirty)

    @view
    def records(self) -> DataFrame:
        """Two loads: the corpus, then the batch; words in both repeat."""
        return append_records(
            shape_records(self.completed_rows, seq=1),
            shape_records(self.batch_scored, seq=2),
        )

    @view
    def lexicon(self) -> DataFrame:
        return build_lexicon(self.records)

    @view
    def nodes(self) -> DataFrame:
        """All corpus words."""
        word = F.col("word")
        return self.scored.select(
            word.alias("name"),
            pos_rule(word).alias("POS"),
            "sentiment",
            "sentiment_score",
            F.concat(F.lit("m_"), word).alias("meaning"),
        )

    @view
    def batch_nodes(self) -> DataFrame:
        """Words of the batch; those with an even number of letters mean the same as in the corpus."""
        word = F.col("word")
        return self.batch_scored.select(
            word.alias("name"),
            pos_rule(word).alias("POS"),
            "sentiment",
            "sentiment_score",
            F.concat(F.when(F.length(word) % 2 == 0, "m_").otherwise("c_"), word).alias("meaning"),
        )

    @view
    def mirror(self) -> DataFrame:
        """The mirror was filled from the batch, so neither store contains the other."""
        return self.batch_nodes.select(
            mirror_key(F.col("name")).alias("key"), node_json().alias("value")
        )

    @view
    def edges(self) -> DataFrame:
        """Relations between corpus words.

        HYPERNYM_OF leads to the stem, MERONYM_OF to the ending, ANTONYM_OF to the word without
        its negation, SYNONYM_OF to the first of the words with the same letters. Every rule gives
        a word at most a fixed number of relations; the endings become hubs.
        """
        words = self.counts.select("word")
        word = F.col("word")
        by_stem = stems(words).select(
            word.alias("src"),
            F.explode(
                F.array(
                    F.struct(F.lit("HYPERNYM_OF").alias("rel"), F.col("stem").alias("dst")),
                    F.struct(F.lit("MERONYM_OF").alias("rel"), F.col("ending").alias("dst")),
                )
            ).alias("to"),
        ).select("src", "to.*")
        negated = F.filter(
            F.array(*(F.lit(n) for n in NEGATIONS)),
            lambda n: F.startswith(word, n) & (F.length(word) >= F.length(n) + 2),
        )
        by_negation = words.select(word, F.explode(negated).alias("n")).select(
            word.alias("src"),
            F.lit("ANTONYM_OF").alias("rel"),
            F.right(word, F.length(word) - F.length("n")).alias("dst"),
        )
        derived = matching(by_stem.unionByName(by_negation), words.select(word.alias("dst")), "dst")
        letters = F.array_join(F.sort_array(F.split(word, "")), "").alias("letters")
        spelled = words.select("word", letters)
        first = spelled.groupBy("letters").agg(F.min("word").alias("dst"))
        synonyms = (
            spelled.join(first, "letters")
            .filter(F.col("dst") != word)
            .select(word.alias("src"), F.lit("SYNONYM_OF").alias("rel"), "dst")
        )
        # each word meets each ending and negation once, so no relation can come twice
        return derived.select(*EDGE.names).unionByName(synonyms)

    @view
    def corrections(self) -> DataFrame:
        """One correction per batch word; the answers and scores include bad ones."""
        word = F.col("word")
        return self.batch_scored.select(
            "word",
            F.when(word.endswith("e"), "Y")
            .when(word.endswith("n"), "N")
            .when(word.endswith("s"), "n")
            .when(word.endswith("t"), "?")
            .otherwise("y")
            .alias("is_correct"),
            F.when(word.startswith("a"), "N").when(word.startswith("o"), "?").otherwise("y").alias("proceed"),
            F.concat(F.lit("c_"), word).alias("meaning"),
            F.lit("noun").alias("pos"),
            "sentiment",
            F.when(word.startswith("e"), "bad").otherwise("0.9").alias("sentiment_scores"),
            *(F.lit("-").alias(c) for c in ("synonyms", "antonyms", "hypernyms", "meronyms")),
        )

    @view
    def entries(self) -> DataFrame:
        """The same words as manual entries."""
        return self.corrections.drop("is_correct", "proceed")

    @view
    def upserts(self) -> DataFrame:
        """Two versions of each batch word with some fields only; the second counts."""
        word = F.col("word")
        first = self.batch_counts.select(
            "word", "count", F.concat(F.lit("u_"), word).alias("meaning"), F.lit(1).alias("seq")
        )
        return first.unionByName(
            first.withColumn("count", F.col("count") + 1).withColumn("seq", F.lit(2))
        )

    @view
    def node_patch(self) -> DataFrame:
        word = F.col("name")
        return self.batch_nodes.select(
            "name",
            F.when(word.endswith("n"), " \t\n").otherwise("patched").alias("POS"),
            F.lit("").alias("sentiment"),
            F.when(word.endswith("e"), "bad").when(word.endswith("s"), "").otherwise("0.9").alias("sentiment_score"),
            F.concat(F.lit("p_"), word).alias("meaning"),
        )

    @view
    def pairs(self) -> DataFrame:
        """A batch word with its stem, and the relation entered for them."""
        found = stems(self.batch_counts.select("word"))
        properties = F.struct(
            F.lit("paired").alias("POS"),
            F.lit(None).cast("string").alias("sentiment"),
            F.concat(F.lit("w_"), "word").alias("meaning"),
        )
        return found.select(
            F.concat_ws(">", "word", "ending").alias("seq"),
            F.col("word").alias("word1"),
            properties.alias("properties1"),
            F.col("stem").alias("word2"),
            F.struct(F.concat(F.lit("s_"), "word").alias("meaning")).alias("properties2"),
            _relation_text(F.col("ending")).alias("relationship"),
        )

    @view
    def edge_patch(self) -> DataFrame:
        return self.pairs.select(
            F.col("word1").alias("src"),
            F.col("word2").alias("dst"),
            F.col("relationship").alias("rel"),
            "seq",
        )

    @view
    def delete_requests(self) -> DataFrame:
        name = F.col("name")
        return (
            self.word_list
            .select(F.col("word").alias("name"))
            .distinct()
            .withColumn("confirm", F.when(name.startswith("b"), "no").otherwise(F.concat(name, F.lit(" \t"))))
        )
