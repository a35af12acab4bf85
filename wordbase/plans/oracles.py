"""The registered queries once more, as plain SQL over the given tables.

``VIEWS`` are the twins of the inputs in ``stand_ins``; ``ORACLES`` the queries. A query lists
the views it needs by using their names; ``sql`` puts them in front, in order.
"""

from __future__ import annotations

import re

from wordbase.plans.stand_ins import (
    ADJECTIVE_ENDINGS,
    ADVERB_ENDINGS,
    ASKED,
    ENDINGS,
    FUNCTION_WORD_LENGTH,
    NEGATIONS,
    NOUN_ENDINGS,
    VERB_ENDINGS,
)
from wordbase.schemas import FLAT


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _ends(word: str, endings) -> str:
    return "(" + " OR ".join(f"{word} LIKE '%{e}'" for e in endings) + ")"


def _tokens(columns: str, table: str) -> str:
    # DuckDB's \b knows ASCII only, so whole runs are cut out and then checked
    return rf"""
        SELECT {columns}word FROM (
            SELECT {columns}unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS word FROM {table}
        ) WHERE regexp_full_match(word, '[a-z]{{2,}}')"""


def _pos(word: str) -> str:
    return f"""CASE WHEN {_ends(word, NOUN_ENDINGS)} THEN 'noun'
        WHEN {_ends(word, ADVERB_ENDINGS)} THEN 'adverb'
        WHEN {_ends(word, VERB_ENDINGS)} THEN 'verb'
        WHEN {_ends(word, ADJECTIVE_ENDINGS)} THEN 'adjective'
        WHEN length({word}) <= {FUNCTION_WORD_LENGTH} THEN 'function' END"""


def _band(label: str, score: str) -> str:
    return f"""coalesce(CASE WHEN {score} > 0.3 AND {score} < 0.7 THEN 'neutral' ELSE {label} END, '-') AS sentiment,
        coalesce(CASE WHEN {score} > 0.3 AND {score} < 0.7 THEN 0.5 ELSE {score} END, 0.0)::DOUBLE AS sentiment_score"""


_FLAT = ", ".join(f'"{c}"' for c in FLAT.names)
_ROUNDED = _FLAT.replace('"sentiment_scores"', "round(sentiment_scores, 6) AS sentiment_scores")
_NODE = 'name, "POS", sentiment, round(sentiment_score, 6) AS sentiment_score, meaning'
_DASHES = "'-' AS synonyms, '-' AS antonyms, '-' AS hypernyms, '-' AS meronyms"

VIEWS = {
    "tokens": _tokens("doc_id, source, ", "documents"),
    "counts": 'SELECT word, count(*) AS "count" FROM tokens GROUP BY word',
    "batch_tokens": _tokens("role, ", "conversations"),
    "batch_counts": """SELECT word, count(*) AS "count", count(*) FILTER (role = 'user') AS user_count
        FROM batch_tokens GROUP BY word""",
    "word_list": _tokens("", "benchmark"),
    "scores": """SELECT word, CASE WHEN raw >= 0.5 THEN 'positive' ELSE 'negative' END AS label,
        greatest(raw, 1 - raw) AS score
        FROM (SELECT word, user_count::DOUBLE / "count" AS raw FROM batch_counts)""",
    "scored": f"""SELECT word, "count", {_band("label", "score")}
        FROM counts LEFT JOIN scores USING (word)""",
    "batch_scored": f"""SELECT word, "count", {_band("label", "score")}
        FROM batch_counts JOIN scores USING (word)""",
    "completed_rows": f"""SELECT word, "count", sentiment, sentiment_score,
        'm_' || word AS meaning, {_pos("word")} AS "POS" FROM scored""",
    "records": f"""
        SELECT word, "count", sentiment, sentiment_score AS sentiment_scores, {_DASHES},
            meaning, "POS" AS pos, 1::BIGINT AS seq FROM completed_rows
        UNION ALL
        SELECT word, "count", sentiment, sentiment_score, {_DASHES}, '-', '-', 2::BIGINT FROM batch_scored""",
    "corpus_lexicon": """SELECT word, "count", meaning, coalesce(pos, '-') AS pos, sentiment,
        sentiment_scores, synonyms, antonyms, hypernyms, meronyms FROM records WHERE seq = 1""",
    "lexicon": """SELECT word, "count", meaning, coalesce(pos, '-') AS pos, sentiment,
        sentiment_scores, synonyms, antonyms, hypernyms, meronyms FROM records
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY seq DESC) = 1""",
    "nodes": f"""SELECT word AS name, {_pos("word")} AS "POS", sentiment, sentiment_score,
        'm_' || word AS meaning FROM scored""",
    "batch_nodes": f"""SELECT word AS name, {_pos("word")} AS "POS", sentiment,
        sentiment_score, CASE WHEN length(word) % 2 = 0 THEN 'm_' ELSE 'c_' END || word AS meaning FROM batch_scored""",
    "possible_edges": f"""
        SELECT word AS src, 'HYPERNYM_OF' AS rel, left(word, length(word) - length(e)) AS dst
        FROM counts, (SELECT unnest([{_list(ENDINGS)}]) AS e)
        WHERE ends_with(word, e) AND length(word) >= length(e) + 2
        UNION ALL
        SELECT word, 'MERONYM_OF', e
        FROM counts, (SELECT unnest([{_list(ENDINGS)}]) AS e)
        WHERE ends_with(word, e) AND length(word) >= length(e) + 2
        UNION ALL
        SELECT word, 'ANTONYM_OF', substring(word, length(n) + 1)
        FROM counts, (SELECT unnest([{_list(NEGATIONS)}]) AS n)
        WHERE starts_with(word, n) AND length(word) >= length(n) + 2""",
    "spelled": """SELECT word, array_to_string(list_sort(string_split(word, '')), '') AS letters
        FROM counts""",
    "edges": """
        SELECT src, rel, dst FROM possible_edges WHERE dst IN (SELECT word FROM counts)
        UNION
        SELECT word, 'SYNONYM_OF', dst FROM spelled
        JOIN (SELECT letters, min(word) AS dst FROM spelled GROUP BY letters) USING (letters)
        WHERE word <> dst""",
    "entries": f"""SELECT word, 'c_' || word AS meaning, 'noun' AS pos, sentiment,
        CASE WHEN word LIKE 'e%' THEN NULL ELSE 0.9::DOUBLE END AS sentiment_scores, {_DASHES},
        CASE WHEN word LIKE '%e' THEN 'Y' WHEN word LIKE '%n' THEN 'N' WHEN word LIKE '%s' THEN 'N'
            WHEN word LIKE '%t' THEN '?' ELSE 'Y' END AS is_correct,
        CASE WHEN word LIKE 'a%' THEN 'N' WHEN word LIKE 'o%' THEN '?' ELSE 'Y' END AS proceed
        FROM batch_scored""",
    "outcomes": """SELECT e.*, c.count AS stored, CASE
            WHEN c.word IS NULL AND e.sentiment_scores IS NULL THEN 'score is no number'
            WHEN c.word IS NULL THEN 'inserted'
            WHEN is_correct = 'Y' THEN 'kept'
            WHEN is_correct = 'N' AND proceed = 'Y' AND e.sentiment_scores IS NULL THEN 'score is no number'
            WHEN is_correct = 'N' AND proceed = 'Y' THEN 'updated'
            WHEN is_correct = 'N' AND proceed = 'N' THEN 'declined'
            ELSE 'invalid answer' END AS outcome
        FROM entries e LEFT JOIN counts c USING (word)""",
    "node_patch": """SELECT name, CASE WHEN name LIKE '%n' THEN NULL ELSE 'patched' END AS "POS",
        CASE WHEN name LIKE '%e' OR name LIKE '%s' THEN NULL ELSE 0.9::DOUBLE END AS sentiment_score,
        'p_' || name AS meaning FROM batch_nodes""",
    "pairs": f"""SELECT word || '>' || e AS seq, word AS word1,
        left(word, length(word) - length(e)) AS word2, 'w_' || word AS meaning1, 's_' || word AS meaning2,
        CASE WHEN e IN ({_list(NOUN_ENDINGS)}) THEN 'SYNONYM_OF'
            WHEN e IN ({_list(VERB_ENDINGS)}) THEN 'HYPONYM_OF'
            WHEN e IN ({_list(ADVERB_ENDINGS)}) THEN NULL ELSE 'HOLONYM_OF' END AS rel
        FROM batch_counts, (SELECT unnest([{_list(ENDINGS)}]) AS e)
        WHERE ends_with(word, e) AND length(word) >= length(e) + 2""",
    "pair_patch": """
        SELECT name,
            max("POS") AS "POS", arg_max(meaning, key) AS meaning
        FROM (
            SELECT word1 AS name, 'paired' AS "POS", meaning1 AS meaning, {'seq': seq, 'side': 1} AS key
            FROM pairs WHERE rel IS NOT NULL
            UNION ALL
            SELECT word2, NULL, meaning2, {'seq': seq, 'side': 2} FROM pairs WHERE rel IS NOT NULL
        ) GROUP BY name""",
    "edge_patch": """SELECT word1 AS src, word2 AS dst, arg_max(rel, seq) AS rel FROM pairs
        WHERE rel IS NOT NULL GROUP BY word1, word2""",
    "accepted_patch": """SELECT * FROM edge_patch
        WHERE src IN (SELECT name FROM nodes) AND dst IN (SELECT name FROM nodes)""",
    "requests": """SELECT DISTINCT word AS name, word NOT LIKE 'b%' AS confirmed FROM word_list""",
    "doomed": """SELECT name FROM requests WHERE confirmed AND name IN (SELECT name FROM nodes)""",
    "existence": """SELECT word, count(*) AS occurrences,
        any_value(word IN (SELECT word FROM batch_counts)) AS in_mirror,
        any_value(word IN (SELECT name FROM nodes)) AS in_graph
        FROM word_list GROUP BY word""",
    "meronyms": """SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges
        WHERE rel = 'MERONYM_OF'""",
    "degrees": """SELECT node, count(*) AS degree
        FROM (SELECT a AS node FROM meronyms UNION ALL SELECT b FROM meronyms) GROUP BY node""",
    "degree_histogram": "SELECT degree, count(*) AS n FROM degrees GROUP BY degree",
    # the best of all ways to cut the degrees into three ranges
    "running": """SELECT degree, sum(n) OVER w AS c, sum(n * degree) OVER w AS s, sum(n * degree * degree) OVER w AS q
        FROM (SELECT degree, n::DOUBLE AS n FROM degree_histogram) WINDOW w AS (ORDER BY degree)""",
    "best_cut": """SELECT a.degree AS lo, b.degree AS hi
        FROM running a JOIN running b ON a.degree < b.degree
        JOIN (SELECT * FROM running ORDER BY degree DESC LIMIT 1) t ON b.degree < t.degree
        ORDER BY (a.q - a.s * a.s / a.c) + (b.q - a.q - (b.s - a.s) ** 2 / (b.c - a.c))
            + (t.q - b.q - (t.s - b.s) ** 2 / (t.c - b.c)), lo, hi LIMIT 1""",
    "clusters": """SELECT node, degree, CASE WHEN degree <= (SELECT lo FROM best_cut) THEN 0
            WHEN degree <= (SELECT hi FROM best_cut) THEN 1 ELSE 2 END AS cluster FROM degrees""",
    "new_words_only": """SELECT word, b."count" FROM batch_counts b ANTI JOIN counts USING (word)""",
    "keys_left": """SELECT 'lexicon:' || word AS key FROM batch_counts
        WHERE NOT regexp_full_match(word, '[a-e].*.n')""",
}

_POS_TABLE = """
    SELECT pos, "count", round(share, 6) AS percentage, format('{:.2f}%', share) AS percent
    FROM (SELECT coalesce("POS", 'UNKNOWN') AS pos, count(*) AS "count",
            100.0::DOUBLE * count(*) / (SELECT count(*) FROM nodes) AS share
        FROM nodes GROUP BY 1)"""

_REPLACED = f"""
    SELECT {_ROUNDED} FROM corpus_lexicon ANTI JOIN patch USING (word)
    UNION ALL SELECT {_FLAT} FROM patch"""


def _summary(relation: str) -> str:
    return f"""SELECT '{relation}' AS relation,
        (SELECT count(*) FROM (SELECT src FROM edges WHERE rel = '{relation}'
            UNION SELECT dst FROM edges WHERE rel = '{relation}')) AS nodes,
        (SELECT count(*) FROM (SELECT DISTINCT least(src, dst), greatest(src, dst)
            FROM edges WHERE rel = '{relation}')) AS edges"""


ORACLES = {
    # collect and count
    "category_titles": """
        SELECT source AS category, doc_id::VARCHAR AS title FROM documents
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id::VARCHAR) <= 25""",
    "category_titles_one": """
        SELECT source AS category, doc_id::VARCHAR AS title FROM documents
        WHERE source = 'src7' ORDER BY title LIMIT 25""",
    "titles_text": """
        SELECT doc_id::VARCHAR AS title, coalesce(text, '') AS text FROM documents
        UNION ALL SELECT url, '' FROM pages""",
    "title_lists": "SELECT source AS category, doc_id::VARCHAR AS title FROM documents",
    "token_rows": "SELECT doc_id, source, word FROM tokens",
    "word_count": 'SELECT word, "count" FROM counts',
    "stream_word_count": """
        SELECT source AS category, word, count(*) AS "count" FROM tokens GROUP BY ALL""",
    # annotate
    "sentiment_scored": """
        SELECT word, "count", sentiment, round(sentiment_score, 6) AS sentiment_score FROM scored""",
    "sentiment_scored_by_model": f"""
        SELECT word, "count", sentiment, round(sentiment_score, 6) AS sentiment_score FROM (
            SELECT word, "count", {_band("label", "score")} FROM (
                SELECT word, "count", CASE WHEN share >= 0.5 THEN 'positive' ELSE 'negative' END AS label,
                    greatest(share, 1 - share) AS score
                FROM (SELECT word, "count",
                    length(regexp_replace(word, '[^aeiou]', '', 'g'))::DOUBLE / length(word) AS share
                    FROM counts)))""",
    "csv_round_trip": """
        SELECT word, "count", sentiment, round(sentiment_score, 6) AS sentiment_score FROM scored""",
    # records and the lexicon
    "records_shaped": f"""
        SELECT word,
            CASE WHEN word LIKE '%x' OR word LIKE '%q' THEN 0 ELSE "count" END AS "count",
            sentiment, round(sentiment_score, 6) AS sentiment_scores, {_DASHES},
            meaning, "POS" AS pos, 1::BIGINT AS seq
        FROM completed_rows WHERE word NOT LIKE '%z' AND word NOT LIKE '%v'""",
    "records_appended": """
        SELECT * REPLACE (round(sentiment_scores, 6) AS sentiment_scores) FROM records""",
    "load_report": """
        SELECT count(*) AS rows,
            count(*) FILTER (word NOT LIKE '%z' AND word NOT LIKE '%v') AS records,
            count(*) FILTER (word LIKE '%z') AS without_count,
            count(*) FILTER (word LIKE '%v') AS repeated_headers,
            0::BIGINT AS without_word
        FROM completed_rows""",
    "records_flat": f"SELECT 'word:' || word AS key, {_ROUNDED} FROM lexicon",
    "flush_refresh": """
        SELECT 'before' AS state, count(*) AS keys FROM lexicon
        UNION ALL SELECT 'flushed', 0
        UNION ALL SELECT 'reloaded', count(*) FROM lexicon""",
    "nodes_from_lexicon": """
        SELECT word AS name, pos AS "POS", sentiment, round(sentiment_scores, 6) AS sentiment_score,
            meaning FROM lexicon""",
    # extremes, distributions, lengths
    "most_common_word": """
        SELECT * REPLACE (round(sentiment_scores, 6) AS sentiment_scores) FROM records
        ORDER BY "count" DESC, word, seq LIMIT 1""",
    "least_common_word": """
        SELECT * REPLACE (round(sentiment_scores, 6) AS sentiment_scores) FROM records
        ORDER BY "count", word, seq LIMIT 1""",
    "records_json": """
        SELECT to_json({'word': word, 'count': "count", 'annotation': {'sentiment': sentiment,
                'sentiment_scores': round(100 * round(sentiment_scores, 2))::BIGINT, 'synonyms': synonyms,
                'antonyms': antonyms, 'hypernyms': hypernyms, 'meronyms': meronyms},
            'meaning': meaning, 'pos': pos, 'seq': seq})::VARCHAR AS json FROM records""",
    "pos_segment": "SELECT pos, count(*) AS words FROM lexicon WHERE pos <> '' GROUP BY pos",
    "sentiment_proportion": """
        SELECT sentiment, upper(left(sentiment, 1)) || substring(sentiment, 2) AS label, words,
            round(share, 6) AS proportion, format('{:.2f}%', 100 * share) AS percent
        FROM (SELECT s AS sentiment, count(word) AS words,
                count(word)::DOUBLE / sum(count(word)) OVER () AS share
            FROM (SELECT unnest(['positive', 'negative', 'neutral']) AS s)
            LEFT JOIN lexicon ON sentiment = s GROUP BY s)""",
    "pos_distribution": _POS_TABLE,
    "pos_sorted_desc": _POS_TABLE,
    "pos_sorted_asc_limit": f'{_POS_TABLE} ORDER BY "count", pos LIMIT 3',
    "pos_general_counts": """
        SELECT count(*) AS total_words, count(DISTINCT coalesce("POS", 'UNKNOWN')) AS distinct_pos
        FROM nodes""",
    "word_total": "SELECT count(*) AS total_words FROM nodes",
    "length_histogram": """
        SELECT length(name)::INTEGER AS "wordLength", count(*) AS "count" FROM nodes GROUP BY 1""",
    "length_mean_median": """
        SELECT round(avg(length(name)), 6) AS mean_length,
            median(length(name))::DOUBLE AS median_length FROM nodes""",
    # look-ups
    "word_lookup": f"""
        SELECT {_ROUNDED}, l.word IS NOT NULL AS found
        FROM (SELECT DISTINCT word FROM word_list) LEFT JOIN lexicon l USING (word)""",
    "word_fields": """
        SELECT word, upper(left(field, 1)) || substring(field, 2) AS field, value FROM (
            UNPIVOT (
                SELECT word, "count"::VARCHAR AS "count", meaning, pos, sentiment,
                    round(sentiment_scores, 2)::VARCHAR AS sentiment_scores, synonyms, antonyms,
                    hypernyms, meronyms
                FROM lexicon WHERE word IN (SELECT word FROM word_list)
            ) ON COLUMNS(* EXCLUDE (word)) INTO NAME field VALUE value)""",
    "word_count_lookup": """
        SELECT word, coalesce("count", 0) AS "count"
        FROM (SELECT DISTINCT word FROM word_list) LEFT JOIN lexicon USING (word)""",
    "sentiment_lookup": """
        SELECT word, l.word IS NOT NULL AS found, coalesce(sentiment, 'N/A') AS sentiment,
            coalesce(round(sentiment_scores, 2)::VARCHAR, 'N/A') AS sentiment_scores
        FROM (SELECT DISTINCT word FROM word_list) LEFT JOIN lexicon l USING (word)""",
    "sentiment_lookup_unknown": "SELECT word FROM new_words_only",
    "word_list_lookup": f"""
        SELECT word, asked, coalesce("count", 0) AS "count"
        FROM (SELECT word, count(*) AS asked FROM (SELECT unnest([{_list(ASKED)}]) AS word) GROUP BY word)
        LEFT JOIN lexicon USING (word)""",
    "coverage_words": "SELECT word, occurrences, in_mirror OR in_graph AS found FROM existence",
    "coverage_percent": """
        SELECT asked, found, round(100.0::DOUBLE * found / asked, 6) AS coverage,
            format('{:.2f}%', 100.0::DOUBLE * found / asked) AS percent
        FROM (SELECT sum(occurrences)::BIGINT AS asked,
                sum(CASE WHEN in_mirror OR in_graph THEN occurrences ELSE 0 END)::BIGINT AS found
            FROM existence)""",
    "word_existence": "SELECT *, in_mirror OR in_graph AS found FROM existence",
    "lexicon_size": """
        SELECT (SELECT count(*) FROM batch_counts) AS mirror_words,
            (SELECT count(*) FROM nodes) AS graph_words,
            (SELECT count(*) FROM (SELECT word FROM batch_counts UNION SELECT name FROM nodes))
                AS total_words""",
    "mirrored_total": "SELECT count(*) AS mirrored_words FROM batch_counts",
    "mirror_refresh": f"""
        SELECT {_NODE} FROM nodes
        UNION ALL SELECT {_NODE} FROM batch_nodes WHERE name NOT IN (SELECT name FROM nodes)""",
    "mirror_refresh_report": "SELECT count(*) AS records, count(name) AS written FROM nodes",
    "store_compare": """
        SELECT w.word, b."POS" AS mirror_pos, b.sentiment AS mirror_sentiment,
            round(b.sentiment_score, 6) AS mirror_sentiment_score, b.meaning AS mirror_meaning,
            n."POS" AS part_of_speech, n.sentiment AS graph_sentiment,
            round(n.sentiment_score, 6) AS graph_sentiment_score, n.meaning AS definition,
            (b.name IS NULL) = (n.name IS NULL) AND b."POS" IS NOT DISTINCT FROM n."POS"
                AND b.sentiment IS NOT DISTINCT FROM n.sentiment AND b.meaning IS NOT DISTINCT FROM n.meaning
                AND b.sentiment_score IS NOT DISTINCT FROM n.sentiment_score AS agree
        FROM (SELECT DISTINCT word FROM word_list) w
        LEFT JOIN batch_nodes b ON b.name = w.word LEFT JOIN nodes n ON n.name = w.word""",
    "read_through": """
        SELECT w.word AS name,
            CASE WHEN b.name IS NOT NULL THEN 'mirror' WHEN n.name IS NOT NULL THEN 'graph' END AS source,
            CASE WHEN b.name IS NOT NULL THEN b."POS" ELSE n."POS" END AS "POS",
            CASE WHEN b.name IS NOT NULL THEN b.sentiment ELSE n.sentiment END AS sentiment,
            round(CASE WHEN b.name IS NOT NULL THEN b.sentiment_score ELSE n.sentiment_score END, 6)
                AS sentiment_score,
            CASE WHEN b.name IS NOT NULL THEN b.meaning ELSE n.meaning END AS meaning
        FROM (SELECT DISTINCT word FROM word_list) w
        LEFT JOIN batch_nodes b ON b.name = w.word LEFT JOIN nodes n ON n.name = w.word""",
    "read_through_fill": """
        SELECT DISTINCT 'lexicon:' || word AS key FROM word_list
        WHERE word IN (SELECT name FROM nodes) AND word NOT IN (SELECT word FROM batch_counts)""",
    # the relation graph
    "neighbours": """
        SELECT src AS word, rel AS relationship, name AS related_name, "POS" AS related_pos,
            meaning AS related_meaning
        FROM edges JOIN nodes ON dst = name WHERE src IN (SELECT word FROM word_list)""",
    "neighbours_all": """
        SELECT src AS word, rel AS relationship, name AS related_name FROM edges JOIN nodes ON dst = name""",
    "word_card": f"""
        SELECT {_NODE}, rel AS relationship, dst AS related_name FROM nodes LEFT JOIN edges ON src = name
        WHERE name IN (SELECT word FROM word_list)""",
    "related_words_top": """
        SELECT src AS word, dst AS related FROM edges
        WHERE rel = 'SYNONYM_OF' AND src IN (
            SELECT DISTINCT src FROM edges WHERE rel = 'SYNONYM_OF' ORDER BY src LIMIT 5)""",
    "relation_edges": """
        SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges
        WHERE rel = 'HYPERNYM_OF'""",
    "graph_summary": " UNION ALL ".join(
        _summary(r) for r in ("SYNONYM_OF", "ANTONYM_OF", "HYPERNYM_OF", "MERONYM_OF")
    ),
    "degree": "SELECT node, degree FROM degrees",
    "degree_clusters": "SELECT node, degree, cluster FROM clusters",
    "degree_clusters_first": "SELECT node, degree, cluster FROM clusters ORDER BY node LIMIT 5",
    "graph_round_trip": """
        SELECT rel AS kind, count(*) AS rows, sum(length(src) + length(dst))::BIGINT AS letters
        FROM edges GROUP BY rel
        UNION ALL SELECT 'node', count(*), sum(length(name))::BIGINT FROM nodes""",
    # the improvement loop
    "new_words": "SELECT word FROM new_words_only",
    "new_words_export": 'SELECT word, 1::BIGINT AS "count" FROM new_words_only',
    "new_words_corpus_count": "SELECT * FROM new_words_only",
    "batch_rows": "SELECT count(*) AS rows FROM batch_counts",
    "import_update": f"""
        SELECT {_ROUNDED} FROM corpus_lexicon
        UNION ALL
        SELECT word, "count", '-', '-', sentiment, round(sentiment_score, 6), '-', '-', '-', '-'
        FROM batch_scored WHERE word NOT IN (SELECT word FROM counts)""",
    "import_update_manual": """
        SELECT (SELECT count(*) FROM counts) + 2 * count(*) AS records,
            (SELECT count(*) FROM counts) + count(*) AS lexicon_words
        FROM new_words_only""",
    # keyed changes
    "insert_records": """
        SELECT word, count(*) AS rows, max(meaning) AS meaning, sum("count")::BIGINT AS "count" FROM (
            SELECT word, meaning, "count" FROM corpus_lexicon
            UNION ALL SELECT word, '-', "count" FROM batch_counts) GROUP BY word""",
    "insert_absent": f"""
        SELECT {_ROUNDED} FROM corpus_lexicon
        UNION ALL
        SELECT word, 1, meaning, pos, sentiment, sentiment_scores, synonyms, antonyms, hypernyms, meronyms
        FROM entries WHERE sentiment_scores IS NOT NULL AND word NOT IN (SELECT word FROM counts)""",
    "insert_absent_rejects": """
        SELECT word, 'score is no number' AS reason FROM entries WHERE sentiment_scores IS NULL
        UNION ALL
        SELECT word, 'already exists' FROM entries
        WHERE sentiment_scores IS NOT NULL AND word IN (SELECT word FROM counts)""",
    "upsert_words": f"""
        WITH patch AS (
            SELECT word, "count" + 1 AS "count", 'u_' || word AS meaning, '-' AS pos, '-' AS sentiment,
                0.0::DOUBLE AS sentiment_scores, {_DASHES} FROM batch_counts)
        {_REPLACED}""",
    "update_fields": f"""
        WITH patch AS (
            SELECT word, coalesce(c."count", 0) AS "count", meaning, pos, sentiment, sentiment_scores,
                synonyms, antonyms, hypernyms, meronyms
            FROM (SELECT * FROM entries WHERE sentiment_scores IS NOT NULL) LEFT JOIN counts c USING (word))
        {_REPLACED}""",
    "corrections": f"""
        WITH patch AS (
            SELECT word, CASE WHEN outcome = 'inserted' THEN 1 ELSE stored END AS "count", meaning, pos,
                sentiment, sentiment_scores, synonyms, antonyms, hypernyms, meronyms
            FROM outcomes WHERE outcome IN ('inserted', 'updated'))
        {_REPLACED}""",
    "correction_outcomes": "SELECT word, outcome FROM outcomes",
    # graph changes
    "create_nodes": f"""
        SELECT {_NODE} FROM nodes
        UNION ALL SELECT {_NODE} FROM batch_nodes ANTI JOIN nodes USING (name) WHERE length('lexicon:' || name) % 2 = 1""",
    "merge_pairs_nodes": """
        SELECT name, coalesce(p."POS", n."POS") AS "POS", sentiment,
            round(sentiment_score, 6) AS sentiment_score, coalesce(p.meaning, n.meaning) AS meaning
        FROM nodes n FULL JOIN pair_patch p USING (name)""",
    "merge_pairs_edges": """
        SELECT src, rel, dst FROM edges
        UNION SELECT word1, rel, word2 FROM pairs WHERE rel IS NOT NULL""",
    "merge_pairs_rejects": """
        SELECT word1, word2, 'related' AS relationship, 'unknown relation' AS reason
        FROM pairs WHERE rel IS NULL""",
    "patch_nodes": """
        SELECT name, coalesce(p."POS", n."POS") AS "POS", sentiment,
            round(coalesce(p.sentiment_score, n.sentiment_score), 6) AS sentiment_score,
            coalesce(p.meaning, n.meaning) AS meaning
        FROM nodes n LEFT JOIN node_patch p USING (name)""",
    "patch_nodes_rejects": """
        SELECT name, 'unknown word' AS reason FROM node_patch
        WHERE name NOT IN (SELECT name FROM nodes)""",
    "set_relation": """
        SELECT e.src, e.rel, e.dst FROM edges e ANTI JOIN accepted_patch a ON e.src = a.src AND e.dst = a.dst
        UNION ALL SELECT src, rel, dst FROM accepted_patch""",
    "set_relation_rejects": """
        SELECT src, dst, CASE WHEN src NOT IN (SELECT name FROM nodes) THEN 'unknown word'
            ELSE 'unknown related word' END AS reason
        FROM edge_patch WHERE src NOT IN (SELECT name FROM nodes) OR dst NOT IN (SELECT name FROM nodes)
        UNION ALL SELECT word1, word2, 'unknown relation' FROM pairs WHERE rel IS NULL""",
    "delete_nodes": f"SELECT {_NODE} FROM nodes ANTI JOIN doomed USING (name)",
    "delete_edges": """
        SELECT src, rel, dst FROM edges ANTI JOIN doomed s ON src = s.name ANTI JOIN doomed d ON dst = d.name""",
    "delete_rejects": """
        SELECT name, CASE WHEN name NOT IN (SELECT name FROM nodes) THEN 'unknown word'
            ELSE 'not confirmed' END AS reason
        FROM requests WHERE NOT confirmed OR name NOT IN (SELECT name FROM nodes)""",
    "delete_mirrored": """
        SELECT 'lexicon:' || word AS key FROM batch_counts ANTI JOIN doomed ON word = name""",
    "delete_keys": "SELECT key FROM keys_left",
    "delete_keys_report": """
        SELECT (SELECT count(*) FROM batch_counts) - count(*) AS deleted FROM keys_left""",
    "node_csv_import": f"""
        SELECT {_NODE} FROM nodes
        UNION ALL
        SELECT name, coalesce("POS", ''), sentiment, round(sentiment_score, 6),
            CASE WHEN name LIKE '%e' THEN 'a "b",' || chr(10) || meaning ELSE meaning END
        FROM batch_nodes ANTI JOIN nodes USING (name)""",
}

# the same result by another way: in place, out of pruned tables, by what changed
ORACLES |= {
    "csv_checked": """
        SELECT word, CASE WHEN word NOT LIKE '%z' THEN "count" END AS "count" FROM counts WHERE NOT regexp_matches(word, '[xqv]$')""",
    "csv_rejects": """
        SELECT word || ',' || "count" || ',more' AS record, 'wrong number of fields' AS reason FROM counts WHERE word LIKE '%x'
        UNION ALL SELECT word, 'wrong number of fields' FROM counts WHERE word LIKE '%q'
        UNION ALL SELECT word || ',bad', 'count is no bigint' FROM counts WHERE word LIKE '%v'""",
    "node_csv_long": """
        SELECT name, "POS", CASE WHEN name LIKE '%e' THEN 'a "b",' || chr(10) || meaning ELSE meaning END AS meaning FROM batch_nodes""",
    "titles_text_laid_out": ORACLES["titles_text"],
    "stream_word_count_laid_out": ORACLES["stream_word_count"],
    "upsert_in_place": ORACLES["upsert_words"],
    "update_in_place": ORACLES["update_fields"],
    "corrections_in_place": ORACLES["corrections"],
    "patch_nodes_in_place": ORACLES["patch_nodes"],
    "delete_nodes_in_place": ORACLES["delete_nodes"],
    "upsert_in_place_report": """
        SELECT 1 AS time, count(*) FILTER (c.word IS NULL) AS added, count(*) FILTER (c.word IS NOT NULL) AS changed, 0::BIGINT AS gone
        FROM batch_counts b LEFT JOIN counts c USING (word)
        UNION ALL SELECT 2, 0, 0, 0""",
    "sentiment_spread": """
        WITH RECURSIVE links AS MATERIALIZED (
            SELECT DISTINCT src, dst, agrees FROM (
                SELECT src, dst, CASE rel WHEN 'SYNONYM_OF' THEN 1 ELSE -1 END AS agrees FROM edges WHERE rel IN ('SYNONYM_OF', 'ANTONYM_OF') AND src <> dst
                UNION ALL SELECT dst, src, CASE rel WHEN 'SYNONYM_OF' THEN 1 ELSE -1 END FROM edges WHERE rel IN ('SYNONYM_OF', 'ANTONYM_OF') AND src <> dst)),
        spread(word, sign, round) USING KEY (word) AS (
            SELECT word, CASE sentiment WHEN 'positive' THEN 1 ELSE -1 END, 0 FROM scored WHERE sentiment IN ('positive', 'negative')
            UNION
            SELECT dst, sign(sum(agrees * sign))::INTEGER, any_value(round) + 1
            FROM spread JOIN links ON src = word
            WHERE NOT EXISTS (SELECT 1 FROM recurring.spread r WHERE r.word = dst)
            GROUP BY dst HAVING sum(agrees * sign) <> 0)
        SELECT word, CASE WHEN sign > 0 THEN 'positive' ELSE 'negative' END AS sentiment, round FROM spread""",
    "word_lookup_pruned": ORACLES["word_lookup"],
    "mirror_lookup_pruned": f"SELECT {_NODE} FROM batch_nodes WHERE name IN ({_list(ASKED)})",
    "mirror_refresh_incremental": """
        SELECT name, coalesce(p."POS", n."POS") AS "POS", sentiment, round(coalesce(p.sentiment_score, n.sentiment_score), 6) AS sentiment_score,
            coalesce(p.meaning, n.meaning) AS meaning
        FROM nodes n LEFT JOIN node_patch p USING (name) ANTI JOIN doomed d USING (name)""",
    "mirror_changes_report": """
        SELECT 0::BIGINT AS added,
            (SELECT count(*) FROM node_patch SEMI JOIN nodes USING (name) ANTI JOIN doomed USING (name)) AS changed,
            (SELECT count(*) FROM doomed) AS gone""",
    "lexicon_refresh_incremental": f"SELECT {_ROUNDED} FROM lexicon",
}


def _used(text: str) -> set[str]:
    return {name for name in VIEWS if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text)}


def sql(name: str) -> str:
    """One query as a single statement with the views it needs."""
    body = ORACLES[name].strip()
    needed, open_ = set(), _used(body)
    while open_:
        needed |= open_
        open_ = set().union(*(_used(VIEWS[v]) for v in open_)) - needed
    # made once each: DuckDB would put a view's text in wherever it is used, and cut the corpus into words each time
    views = [f'"{v}" AS MATERIALIZED ({VIEWS[v].strip()})' for v in VIEWS if v in needed]
    if body.startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join([*views, body.removeprefix("WITH RECURSIVE ")])
    if body.startswith("WITH "):
        views.append(body.removeprefix("WITH "))
        return "WITH " + ",\n".join(views)
    return ("WITH " + ",\n".join(views) + "\n" if views else "") + body
