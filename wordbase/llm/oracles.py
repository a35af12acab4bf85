"""SQL twins of the registered queries of this package, for DuckDB, where SQL can say the same."""


def _vector_codes(rounds: int = 4) -> str:
    """Codebooks by rounds of assignments, each a common table, over every pair of a part and an entry."""

    def assigned(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (
            SELECT p.row, p.part, arg_min(b.entry, (far(p.v, b.v), b.entry)) AS entry, min(far(p.v, b.v)) AS error
            FROM parts p JOIN {book} b USING (part) GROUP BY ALL)"""

    def far_inlined(text: str) -> str:
        return text.replace("far(p.v, b.v)", "coalesce(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0)::BIGINT")

    steps = []
    for i in range(rounds):
        steps += [
            assigned(f"a{i}", f"book{i}"),
            f"""sums{i} AS (
            SELECT part, entry, place, sum(v[place])::BIGINT AS s, count(*) AS c
            FROM a{i} JOIN parts USING (row, part), range(1, 1 + (SELECT max(len(v)) FROM parts)) t(place) WHERE place <= len(v) GROUP BY ALL)""",
            f"""means{i} AS (
            SELECT part, entry, list((s - ((s % c + c) % c)) // c ORDER BY place)::BIGINT[] AS v FROM sums{i} GROUP BY ALL)""",
            f"""book{i + 1} AS MATERIALIZED (
            SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN means{i} m USING (part, entry))""",
        ]
    steps.append(assigned("final", f"book{rounds}"))
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (
            SELECT row, vec_id, part, list_transform(e[part * len(e) // 4 + 1:(part + 1) * len(e) // 4], lambda x: floor(1024 * x)::BIGINT) AS v
            FROM kept, range(4) t(part)),
        book0 AS MATERIALIZED (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM parts
            WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT 256)),
        {far_inlined(", ".join(steps))},
        coded AS (
            SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error FROM final GROUP BY row),
        digest AS (
            SELECT sha256(string_agg(v[place]::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256
            FROM book{rounds}, range(1, 1 + (SELECT max(len(v)) FROM parts)) t(place) WHERE place <= len(v))
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (row), digest
    """


_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"
).replace("'", "''")
_SPACE = "[:space:]"
#: kind, what stands before a match, the match, and what else must hold of it
_SECRETS = [
    ("assign", "()", _ASSIGN, f"length(regexp_extract(piece, '{_ASSIGN}', 2)) >= 8"),
    ("access", "()", "AKIA[A-Z0-9]+", "length(piece) >= 16"),
    ("hex", "()", "[0-9a-f]+", "length(piece) >= 32"),
    ("pem", "()", "-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY(?: BLOCK)?-----", "true"),
    ("jwt", "(^|[^A-Za-z0-9_-])", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "true"),
    ("prefixed", "(^|[^A-Za-z0-9_-])", "(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{16,}|AIza[A-Za-z0-9_-]{35}"
     "|sk_live_[A-Za-z0-9]{16,}|glpat-[A-Za-z0-9_-]{20,})", "true"),
    ("address", "(://)", f"[^{_SPACE}/:@]{{1,64}}:[^{_SPACE}/:@]{{4,128}}@", "true"),
]


def _secret_scan() -> str:
    """Marks around the matches turn each text into gaps and matches in turn, whose lengths add up to places."""
    pieces = " UNION ALL ".join(
        rf"""SELECT row, {order} AS place, '{kind}' AS kind, string_split(regexp_replace(text, '{before}({match})', '\1' || chr(1) || '\2' || chr(1), 'g'), chr(1)) AS p
            FROM texts"""
        for order, (kind, before, match, _) in enumerate(_SECRETS)
    )
    checks = " ".join(f"WHEN '{kind}' THEN {check}" for kind, _, _, check in _SECRETS)
    every = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)"
    return f"""
        WITH texts AS MATERIALIZED (
            SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS text FROM documents),
        pieces AS ({pieces}),
        numbered AS (
            SELECT row, place, kind, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS n FROM pieces WHERE len(p) > 1),
        placed AS (
            SELECT *, (sum(length(piece)) OVER (PARTITION BY row, kind ORDER BY n))::BIGINT AS stop FROM numbered),
        spans AS (
            SELECT row, place, kind, stop - length(piece) AS start, stop FROM placed WHERE n % 2 = 0 AND CASE kind {checks} END),
        found AS (
            SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                   {every} FILTER (place < 3) AS base, {every} AS spans
            FROM spans GROUP BY row)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts LEFT JOIN found USING (row)
    """


_PHRASES = r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece
            FROM documents),
        words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
        f AS MATERIALIZED (
            SELECT lang, size, phrase, count(*) AS f FROM (
                SELECT lang, 1 AS size, unnest(w) AS phrase FROM words UNION ALL
                SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words UNION ALL
                SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words)
            GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
        cuts AS (
            SELECT c.*, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM c, range(1, 3) t(k) WHERE k < size),
        scores AS (
            SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c JOIN f x ON c.lang = x.lang AND c.x = x.phrase JOIN f y ON c.lang = y.lang AND c.y = y.phrase),
        lowest AS (
            SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, phrase, max(a) AS longer FROM (
                SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE size = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE size = 3)
            GROUP BY ALL),
        kept AS (
            SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
    """


ORACLES: dict[str, str] = {
    "op11_phrases": _PHRASES,
    "op12_secret_scan": _secret_scan(),
    "op13_vector_codes": _vector_codes(),
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
