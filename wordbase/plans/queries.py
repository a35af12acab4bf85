"""The registered queries: every operator over whole tables, from the given files to a result.

Each function takes ``(spark, sf_dir)``. Doubles are rounded here, and only here, so that
results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordbase.functions.scoring import model_scorer
from wordbase.operators import (
    changes,
    differences,
    graph_changes,
    lookups,
    network,
    propagation,
    records,
    sentiment,
    sentiment_model,
    sets,
    stats,
    tokens,
)
from wordbase.operators.keyed import listed
from wordbase.plans.stand_ins import ASKED, Inputs
from wordbase.runtime import scratch_path
from wordbase.schemas import FREQUENCY, MIRROR_PREFIX, NODE, NODE_PROPERTIES, SCORED
from wordbase.sources import articles, csv, keyed_tables, messages, runs, stores
from wordbase.streaming import clean

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WHEN = datetime(2024, 12, 12, 21, 8, 30)
STAMP = runs.run_stamp(WHEN)
OWNER = "wordbase"
BUCKETS = 64  #: folders of the tables laid out by key, for sizes as those of the tests


def query(*keep: str):
    """Register a function of ``Inputs``; ``keep`` names the inputs it reads several times."""

    def register(build: Callable[[Inputs], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Inputs(spark, sf_dir, *keep))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        return run

    return register


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- collect and count ----------------------------------------------------


def _articles(i: Inputs, *columns: str) -> DataFrame:
    renamed = {"source": F.col("source").alias("category"), "text": F.col("text")}
    return i.documents(*columns).select(
        F.col("doc_id").cast("string").alias("title"), *(renamed[c] for c in columns)
    )


@query()
def category_titles(i):
    """The first 25 titles of every category."""
    return articles.category_titles(_articles(i, "source"), 25)


@query()
def category_titles_one(i):
    """The first 25 titles of one category."""
    return articles.category_titles(_articles(i, "source"), 25, "src7")


@query()
def titles_text(i):
    """Texts of all article titles; page addresses are titles without an article."""
    addresses = i.table("pages").select(F.col("url").alias("title"), F.lit(None).cast("string").alias("category"))
    titles = _articles(i, "source").unionByName(addresses)
    return articles.article_texts(titles, _articles(i, "source", "text"), unique=True).select("title", "text")


@query()
def titles_text_laid_out(i):
    """The same out of articles in buckets, which are not moved for it."""
    addresses = i.table("pages").select(F.col("url").alias("title"), F.lit(None).cast("string").alias("category"))
    titles = _articles(i, "source").unionByName(addresses)
    laid_out = articles.lay_out_articles(_articles(i, "source", "text"), BUCKETS)
    return articles.article_texts(titles, laid_out, unique=True).select("title", "text")


@query()
def title_lists(i):
    """The title messages, read back one row per title."""
    sent = messages.title_messages(_articles(i, "source"))
    return messages.decode_titles(sent, "category")[0]


@query()
def token_rows(i):
    return tokens.token_rows(i.documents("source", "text"), "doc_id", "source")


@query()
def word_count(i):
    return i.counts


def _streamed_counts(i: Inputs, texts: DataFrame) -> DataFrame:
    """Publish the title lists, clean them as a stream, add the messages of a category up."""
    root = scratch_path(i.spark, "stream")
    sent = messages.title_messages(_articles(i, "source"))
    messages.write_messages(sent, f"{root}/messages")
    clean.clean_messages(
        clean.read_messages(i.spark, f"{root}/messages"),
        texts,
        root,
        STAMP,
        OWNER,
        f"{root}/checkpoint",
        unique=True,
        available_now=True,
    ).awaitTermination()
    counted = clean.cleaned_messages(i.spark, root, STAMP, OWNER)
    category = clean.category_of(F.col("message_id")).alias("category")
    return counted.groupBy(category, "word").agg(F.sum("count").alias("count"))


@query()
def stream_word_count(i):
    return _streamed_counts(i, _articles(i, "source", "text"))


@query()
def stream_word_count_laid_out(i):
    """The same with articles in buckets, so that a batch shuffles titles only."""
    return _streamed_counts(i, articles.lay_out_articles(_articles(i, "source", "text"), BUCKETS))


# --- annotate --------------------------------------------------------------


@query()
def sentiment_scored(i):
    return _rounded(i.scored, "sentiment_score")


def _vowel_model():
    """Stands in for a sentiment model: the share of vowels in the word."""

    def score(words: list[str]) -> list[tuple[str, float]]:
        shares = [sum(letter in "aeiou" for letter in word) / len(word) for word in words]
        return [("positive" if s >= 0.5 else "negative", max(s, 1 - s)) for s in shares]

    return score


@query()
def sentiment_scored_by_model(i):
    scored = sentiment.score_sentiment(i.counts, model_scorer(_vowel_model))
    return _rounded(scored, "sentiment_score")


def _held_out(word):
    return F.crc32(word.cast("binary")) % 5 == 1


def _careless_lines(i: Inputs) -> str:
    """The corpus counts as lines of a CSV, some with a field too many or too few, or with a bad or a blank count."""
    word = F.col("word")
    rest = (
        F.when(word.endswith("x"), F.concat(F.lit(","), "count", F.lit(",more")))
        .when(word.endswith("q"), "")
        .when(word.endswith("v"), ",bad")
        .when(word.endswith("z"), ",")
        .otherwise(F.concat(F.lit(","), "count"))
    )
    path = scratch_path(i.spark, "lines")
    i.counts.select(F.concat(word, rest).alias("value")).write.text(path)
    return path


@query("counts")
def csv_checked(i):
    """The lines that are as declared."""
    return csv.read_csv_checked(i.spark, _careless_lines(i), FREQUENCY, header=False)[0]


@query("counts")
def csv_rejects(i):
    """The lines that are not, with the reason."""
    return csv.read_csv_checked(i.spark, _careless_lines(i), FREQUENCY, header=False)[1].select("record", "reason")


@query("counts", "scores")
def sentiment_scored_by_fitted_model(i):
    """All corpus words, by a model of the labelled words but a fifth."""
    model = sentiment_model.fit(i.scores.where(~_held_out(F.col("word"))))
    return _rounded(sentiment.score_sentiment(i.counts, model), "sentiment_score")


@query("scores")
def sentiment_model_report(i):
    """How many of the fifth the model has right."""
    held_out = _held_out(F.col("word"))
    return sentiment_model.report(i.scores.where(held_out), sentiment_model.fit(i.scores.where(~held_out)))


@query("counts")
def sentiment_spread(i):
    """Labels of scored words, spread along synonyms and antonyms."""
    sign = F.when(F.col("sentiment") == "positive", 1).when(F.col("sentiment") == "negative", -1)
    seeds = i.scored.select("word", sign.alias("sign")).where("sign IS NOT NULL")
    reached = propagation.spread_sentiment(i.edges, seeds)
    return reached.select("word", F.when(F.col("sign") > 0, "positive").otherwise("negative").alias("sentiment"), "round")


@query()
def csv_round_trip(i):
    """Frequencies to the cleaned area, annotated into the labelled one, read for one run."""
    root = scratch_path(i.spark, "runs")
    runs.write_run(i.counts, root, runs.CLEANED, STAMP, OWNER)
    sentiment.annotate_run(i.spark, root, runs.CLEANED, STAMP, OWNER, i.scores)
    back = runs.read_run(i.spark, root, runs.LABELLED_CLEANED, STAMP, OWNER, SCORED)
    return _rounded(back, "sentiment_score")


# --- records and the lexicon -----------------------------------------------


def _flat_columns(nested: DataFrame) -> DataFrame:
    return nested.select(
        "word", "count", "annotation.*", "meaning", "pos", *(c for c in ("seq",) if c in nested.columns)
    )


@query()
def records_shaped(i):
    """Carelessly exported rows as records."""
    return _rounded(_flat_columns(records.shape_records(i.raw_rows, seq=1)), "sentiment_scores")


@query()
def records_appended(i):
    """Both loads, repeats kept; the second lacks the annotation columns."""
    return _rounded(_flat_columns(i.records), "sentiment_scores")


@query()
def load_report(i):
    return records.load_report(i.raw_rows)


@query()
def records_flat(i):
    """The keyed scan of the deduplicated lexicon."""
    return _rounded(stores.keyed_scan(i.lexicon), "sentiment_scores")


@query()
def flush_refresh(i):
    """Keys before, after emptying, and after the reload."""
    lexicon = i.lexicon
    states = {
        "before": lexicon,
        "flushed": changes.flush(lexicon),
        "reloaded": records.build_lexicon(i.records),
    }
    rows = [
        table.agg(F.count("*").alias("keys")).select(F.lit(state).alias("state"), "keys")
        for state, table in states.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query()
def nodes_from_lexicon(i):
    return _rounded(records.nodes_from_lexicon(i.lexicon), "sentiment_score")


# --- extremes, distributions, lengths ----------------------------------------


@query()
def most_common_word(i):
    return _rounded(_flat_columns(stats.most_common(i.records, "seq")), "sentiment_scores")


@query()
def least_common_word(i):
    return _rounded(_flat_columns(stats.least_common(i.records, "seq")), "sentiment_scores")


@query()
def records_json(i):
    """Every record as JSON text, its annotation included; scores in hundredths."""
    score = (100 * F.round("annotation.sentiment_scores", 2)).cast("long")
    whole = i.records.withColumn("annotation", F.col("annotation").withField("sentiment_scores", score))
    return lookups.record_json(whole, "word", "count", "annotation", "meaning", "pos", "seq")


@query()
def pos_segment(i):
    return stats.pos_segments(i.lexicon)


@query()
def sentiment_proportion(i):
    shares = sentiment.sentiment_proportions(i.lexicon)
    return _rounded(shares, "proportion")


@query()
def pos_distribution(i):
    return _rounded(stats.pos_distribution(i.nodes), "percentage")


@query()
def pos_sorted_desc(i):
    return _rounded(stats.sorted_pos(i.nodes), "percentage")


@query()
def pos_sorted_asc_limit(i):
    return _rounded(stats.sorted_pos(i.nodes, "asc", 3), "percentage")


@query()
def pos_general_counts(i):
    return stats.general_counts(i.nodes)


@query()
def word_total(i):
    return stats.word_total(i.nodes)


@query()
def length_histogram(i):
    return stats.length_histogram(i.nodes)


@query()
def length_mean_median(i):
    return _rounded(stats.length_summary(stats.length_histogram(i.nodes)), "mean_length")


# --- look-ups -----------------------------------------------------------------


@query()
def word_lookup(i):
    return _rounded(lookups.find_words(i.lexicon, i.word_list), "sentiment_scores")


@query("counts")
def word_lookup_pruned(i):
    """The same out of a table laid out by word, of which only the folders of the listed words are read."""
    table = keyed_tables.create(i.lexicon, scratch_path(i.spark, "lexicon"), "word", BUCKETS)
    found = keyed_tables.look_up(i.spark, table, i.word_list)
    return _rounded(lookups.find_words(found, i.word_list), "sentiment_scores")


@query()
def mirror_lookup_pruned(i):
    """Mirror rows of words that come as a list of the caller, out of a mirror laid out by key."""
    table = keyed_tables.create(i.mirror, scratch_path(i.spark, "mirror"), "key", BUCKETS)
    found = keyed_tables.look_up(i.spark, table, [f"{MIRROR_PREFIX}{word}" for word in ASKED])
    return _rounded(lookups.mirror_nodes(found), "sentiment_score")


@query()
def word_fields(i):
    """Fields of the records of the listed words, one row per field."""
    found = lookups.find_words(i.lexicon, i.word_list).filter("found").drop("found")
    whole = found.withColumn("sentiment_scores", F.round("sentiment_scores", 2))
    return lookups.record_fields(whole)


@query()
def word_count_lookup(i):
    return lookups.stored_counts(i.lexicon, i.word_list)


@query()
def sentiment_lookup(i):
    found, _ = sentiment.word_sentiment(i.lexicon.withColumn("sentiment_scores", F.round("sentiment_scores", 2)), i.word_list)
    return found


@query()
def sentiment_lookup_unknown(i):
    """Words without a record, to be inserted; asked of the corpus counts for batch words."""
    _, unknown = sentiment.word_sentiment(
        records.build_lexicon(records.shape_records(i.completed_rows, seq=1)), i.batch_counts
    )
    return unknown


@query()
def coverage_words(i):
    return stats.coverage_report(i.word_list, i.mirror, i.nodes)


@query()
def coverage_percent(i):
    return _rounded(stats.coverage(i.word_list, i.mirror, i.nodes), "coverage")


@query()
def word_existence(i):
    return lookups.word_existence(i.word_list, i.mirror, i.nodes)


@query()
def lexicon_size(i):
    return stats.lexicon_size(i.mirror, i.nodes)


@query()
def mirrored_total(i):
    return stats.mirrored_total(i.mirror)


@query("counts", "batch_counts")
def mirror_refresh(i):
    """The mirror after a sync with the graph, parsed back."""
    fresh = lookups.refresh_mirror(i.mirror, i.nodes)
    return _rounded(lookups.mirror_nodes(fresh), "sentiment_score")


def _nodes_later(i: Inputs) -> DataFrame:
    """The nodes after a patch and after deletes."""
    patched = graph_changes.patch_nodes(i.nodes, i.node_patch).nodes
    return graph_changes.delete_nodes(patched, i.edges.filter("false"), i.delete_requests).nodes


def _mirror_changes(i: Inputs) -> DataFrame:
    before = differences.state_of(lookups.mirror_of(i.nodes), "key")
    return differences.difference(before, lookups.mirror_of(_nodes_later(i)), "key")


@query("counts", "batch_counts")
def mirror_refresh_incremental(i):
    """A full mirror brought up to date with what a patch and deletes changed in the nodes, parsed back."""
    fresh = differences.apply_difference(lookups.mirror_of(i.nodes), _mirror_changes(i), "key")
    return _rounded(lookups.mirror_nodes(fresh), "sentiment_score")


@query("counts", "batch_counts")
def mirror_changes_report(i):
    return differences.difference_report(_mirror_changes(i))


@query("counts", "batch_counts")
def lexicon_refresh_incremental(i):
    """The lexicon of the first load brought up to date with what the second load changed."""
    first = records.build_lexicon(i.records.filter("seq = 1"))
    changed = differences.difference(differences.state_of(first, "word"), i.lexicon, "word")
    return _rounded(differences.apply_difference(first, changed, "word"), "sentiment_scores")


@query()
def mirror_refresh_report(i):
    return lookups.refresh_report(i.nodes)


@query()
def store_compare(i):
    """Every property of the listed words in both stores."""
    both = lookups.compare_stores(i.word_list, i.mirror, i.nodes)
    flat = both.select(
        "word",
        *(F.col(f"mirror_data.{c}").alias(f"mirror_{c.lower()}") for c in NODE_PROPERTIES),
        F.col("graph_data.part_of_speech"),
        F.col("graph_data.sentiment").alias("graph_sentiment"),
        F.col("graph_data.sentiment_score").alias("graph_sentiment_score"),
        F.col("graph_data.definition"),
        "agree",
    )
    return _rounded(flat, "mirror_sentiment_score", "graph_sentiment_score")


@query()
def word_list_lookup(i):
    """Counts of words that come as a list of the caller, in the order asked."""
    asked = listed(i.lexicon, ASKED)
    return asked.groupBy("word").agg(F.count("*").alias("asked")).join(lookups.stored_counts(i.lexicon, ASKED), "word")


@query()
def read_through(i):
    answer, _ = lookups.read_through(i.word_list, i.mirror, i.nodes)
    return _rounded(answer, "sentiment_score")


@query()
def read_through_fill(i):
    """Keys the read-through adds to the mirror."""
    _, added = lookups.read_through(i.word_list, i.mirror, i.nodes)
    return added.select("key")


# --- the relation graph --------------------------------------------------------


@query("counts", "edges")
def neighbours(i):
    """Outgoing relations of the listed words."""
    found = lookups.neighbours(i.edges, i.nodes, i.word_list)
    return found.select(
        "word",
        "relationship",
        F.col("related.name").alias("related_name"),
        F.col("related.POS").alias("related_pos"),
        F.col("related.meaning").alias("related_meaning"),
    )


@query("counts", "edges")
def neighbours_all(i):
    """Outgoing relations of every word."""
    found = lookups.neighbours(i.edges, i.nodes)
    return found.select("word", "relationship", F.col("related.name").alias("related_name"))


@query("counts", "edges")
def word_card(i):
    """Properties of the listed words with their relations: one row each, one without for a word that has none."""
    return _rounded(lookups.word_cards(i.word_list, i.nodes, i.edges), "sentiment_score")


@query("counts")
def related_words_top(i):
    return network.related_words(i.edges, "synonym")


@query("counts")
def relation_edges(i):
    return network.undirected(network.relation_edges(i.edges, "hypernym"))


@query("counts")
def graph_summary(i):
    return network.graph_summaries(i.edges, ["synonym", "antonym", "hypernym", "meronym"])


def _meronym_degrees(i: Inputs) -> DataFrame:
    return network.degrees(network.undirected(network.relation_edges(i.edges, "meronym")))


@query("counts")
def degree(i):
    return _meronym_degrees(i)


@query("counts")
def degree_clusters(i):
    return network.degree_clusters(_meronym_degrees(i))


@query("counts")
def degree_clusters_first(i):
    return network.first_nodes(network.degree_clusters(_meronym_degrees(i)))


@query("counts")
def graph_round_trip(i):
    """Both graph tables saved, loaded and counted by relation; nodes as their own kind."""
    path = scratch_path(i.spark, "graph")
    stores.save_graph(i.nodes, i.edges, path)
    nodes, edges = stores.load_graph(i.spark, path)
    per_relation = edges.groupBy(F.col("rel").alias("kind")).agg(
        F.count("*").alias("rows"), F.sum(F.length("src") + F.length("dst")).alias("letters")
    )
    return per_relation.unionByName(
        nodes.agg(F.count("*").alias("rows"), F.sum(F.length("name")).alias("letters")).select(
            F.lit("node").alias("kind"), "rows", "letters"
        )
    )


# --- the improvement loop --------------------------------------------------------


@query()
def new_words(i):
    return sets.new_words(i.batch_counts, i.counts)


@query()
def new_words_export(i):
    return sets.new_word_counts(i.batch_counts, i.counts)


@query()
def new_words_corpus_count(i):
    return sets.new_word_counts(i.batch_counts, i.counts, "corpus")


@query()
def batch_rows(i):
    return stats.row_total(i.batch_counts)


@query("counts", "records", "batch_counts")
def import_update(i):
    """New words exported, annotated, imported again; the lexicon after it."""
    root = scratch_path(i.spark, "update")
    base = i.records.filter("seq = 1")
    sets.export_new_words(i.batch_counts, i.counts, root, WHEN, OWNER, "corpus")
    sentiment.annotate_run(i.spark, root, runs.UPDATE, STAMP, OWNER, i.scores)
    appended, lexicon = sets.import_update(i.spark, base, root, 1, STAMP, OWNER, seq=3)
    return _rounded(lexicon, "sentiment_scores")


@query("counts", "records")
def import_update_manual(i):
    """The same from the update area, without labels, imported twice."""
    root = scratch_path(i.spark, "update")
    base = i.records.filter("seq = 1")
    sets.export_new_words(i.batch_counts, i.counts, root, WHEN, OWNER)
    once, _ = sets.import_update(i.spark, base, root, 2, STAMP, OWNER, seq=3)
    twice, lexicon = sets.import_update(i.spark, once, root, 2, STAMP, OWNER, seq=4)
    return twice.agg(F.count("*").alias("records")).withColumn(
        "lexicon_words", lexicon.agg(F.count("*")).scalar()
    )


# --- keyed changes ------------------------------------------------------------------


def _corpus_lexicon(i: Inputs) -> DataFrame:
    """Corpus words only: they are unique, so no repeats have to be resolved."""
    return records.flatten(records.shape_records(i.completed_rows))


@query()
def insert_records(i):
    """Rows added without a key check, per word."""
    grown = changes.insert_records(_corpus_lexicon(i), i.batch_counts.select("word", "count"))
    return grown.groupBy("word").agg(
        F.count("*").alias("rows"), F.max("meaning").alias("meaning"), F.sum("count").alias("count")
    )


@query("counts", "batch_counts")
def insert_absent(i):
    """Manual entries: new words come in with count 1."""
    return _rounded(changes.enter_new(_corpus_lexicon(i), i.entries).lexicon, "sentiment_scores")


@query("counts", "batch_counts")
def insert_absent_rejects(i):
    return changes.enter_new(_corpus_lexicon(i), i.entries).rejects


@query()
def upsert_words(i):
    return _rounded(changes.upsert(_corpus_lexicon(i), i.upserts), "sentiment_scores")


@query("counts", "batch_counts")
def update_fields(i):
    """Manual updates keep the stored count."""
    return _rounded(changes.update_fields(_corpus_lexicon(i), i.entries).lexicon, "sentiment_scores")


@query("counts", "batch_counts")
def corrections(i):
    lexicon, _ = changes.correct(_corpus_lexicon(i), i.corrections)
    return _rounded(lexicon, "sentiment_scores")


@query("counts", "batch_counts")
def correction_outcomes(i):
    return changes.correct(_corpus_lexicon(i), i.corrections)[1]


def _changed_in_place(i: Inputs, rows: DataFrame, key: str, patch: DataFrame, apply, times: int = 1):
    """A table laid out by key after a change in place, and the outcome of each time it was made."""
    table = keyed_tables.create(rows, scratch_path(i.spark, "keyed"), key, BUCKETS)
    outcomes = [keyed_tables.change(i.spark, table, patch, apply) for _ in range(times)]
    return keyed_tables.read(i.spark, table), outcomes


@query("counts", "batch_counts")
def upsert_in_place(i):
    """The upserts made in the folders of their words."""
    after, _ = _changed_in_place(i, _corpus_lexicon(i), "word", i.upserts, lambda part: changes.upsert(part, i.upserts))
    return _rounded(after, "sentiment_scores")


@query("counts", "batch_counts")
def upsert_in_place_report(i):
    """What the upserts change, and what they change when made again."""
    _, outcomes = _changed_in_place(i, _corpus_lexicon(i), "word", i.upserts, lambda part: changes.upsert(part, i.upserts), 2)
    return i.spark.createDataFrame([(n, *o[:3]) for n, o in enumerate(outcomes, 1)], "time int, added long, changed long, gone long")


@query("counts", "batch_counts")
def update_in_place(i):
    after, _ = _changed_in_place(i, _corpus_lexicon(i), "word", i.entries, lambda part: changes.update_fields(part, i.entries).lexicon)
    return _rounded(after, "sentiment_scores")


@query("counts", "batch_counts")
def corrections_in_place(i):
    after, _ = _changed_in_place(i, _corpus_lexicon(i), "word", i.corrections, lambda part: changes.correct(part, i.corrections)[0])
    return _rounded(after, "sentiment_scores")


@query("counts", "batch_counts")
def patch_nodes_in_place(i):
    after, _ = _changed_in_place(i, i.nodes, "name", i.node_patch, lambda part: graph_changes.patch_nodes(part, i.node_patch).nodes)
    return _rounded(after, "sentiment_score")


@query("counts")
def delete_nodes_in_place(i):
    none = i.edges.filter("false")
    after, _ = _changed_in_place(i, i.nodes, "name", i.delete_requests, lambda part: graph_changes.delete_nodes(part, none, i.delete_requests).nodes)
    return _rounded(after, "sentiment_score")


# --- graph changes --------------------------------------------------------------------


@query("counts", "batch_counts")
def create_nodes(i):
    """Batch words become nodes unless the graph or the mirror has them; half of the mirror is there yet."""
    filled = i.mirror.filter(F.length("key") % 2 == 0)
    return _rounded(graph_changes.create_nodes(i.nodes, i.batch_nodes, filled), "sentiment_score")


@query("counts", "pairs")
def merge_pairs_nodes(i):
    empty = i.edges.filter("false")
    return _rounded(graph_changes.merge_pairs(i.nodes, empty, i.pairs).nodes, "sentiment_score")


@query("counts")
def merge_pairs_edges(i):
    return graph_changes.merge_pairs(i.nodes, i.edges, i.pairs).edges


@query()
def merge_pairs_rejects(i):
    return graph_changes.merge_pairs(i.nodes, i.edges, i.pairs).rejects


@query("counts", "batch_counts")
def patch_nodes(i):
    return _rounded(graph_changes.patch_nodes(i.nodes, i.node_patch).nodes, "sentiment_score")


@query("counts", "batch_counts")
def patch_nodes_rejects(i):
    return graph_changes.patch_nodes(i.nodes, i.node_patch).rejects


@query("counts", "edge_patch")
def set_relation(i):
    return graph_changes.set_relations(i.nodes, i.edges, i.edge_patch).edges


@query("counts", "edge_patch")
def set_relation_rejects(i):
    return graph_changes.set_relations(i.nodes, i.edges, i.edge_patch).rejects


@query("counts")
def delete_nodes(i):
    nodes = graph_changes.delete_nodes(i.nodes, i.edges, i.delete_requests).nodes
    return _rounded(nodes, "sentiment_score")


@query("counts", "edges")
def delete_edges(i):
    return graph_changes.delete_nodes(i.nodes, i.edges, i.delete_requests).edges


@query("counts")
def delete_rejects(i):
    return graph_changes.delete_nodes(i.nodes, i.edges, i.delete_requests).rejects


@query("counts")
def delete_mirrored(i):
    """Mirror keys left after the confirmed words are deleted."""
    return graph_changes.delete_nodes(i.nodes, i.edges, i.delete_requests, i.mirror).mirror.select("key")


@query()
def delete_keys(i):
    """Mirror keys left after deleting by pattern."""
    left, _ = graph_changes.delete_keys(i.mirror, "lexicon:[a-e]*?n")
    return left.select("key")


@query()
def delete_keys_report(i):
    return graph_changes.delete_keys(i.mirror, "lexicon:[a-e]*?n")[1]


@query("counts", "nodes")
def node_csv_import(i):
    """Batch nodes, some with a line break or a quote in their meaning, written as CSV and imported into the graph.

    Counting, scoring and importing are tasks of their own: no task holds the rows of all three at once.
    """
    path = scratch_path(i.spark, "nodes")
    broken = F.when(F.col("name").endswith("e"), F.concat(F.lit('a "b",\n'), "meaning")).otherwise(F.col("meaning"))
    csv.write_csv(i.batch_nodes.withColumn("meaning", broken).withColumnRenamed("name", "word"), path)
    read = csv.read_node_csv(i.spark, path, multi_line=True)
    return _rounded(graph_changes.create_nodes(i.nodes, read), "sentiment_score")


@query()
def node_csv_long(i):
    """The same lines as rows, put together by tasks that each read a block."""
    path = scratch_path(i.spark, "nodes")
    broken = F.when(F.col("name").endswith("e"), F.concat(F.lit('a "b",\n'), "meaning")).otherwise(F.col("meaning"))
    csv.write_csv(i.batch_nodes.select("name", "POS", broken.alias("meaning")), path)
    return csv.read_long_csv(i.spark, path, NODE)
