"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a span classifier decides.

Base spans are those that the strict patterns and checks find; they always stay. Candidates beside them come from looser
patterns (written-out addresses, numbers without a plus sign, numbers that fail a check, long IP addresses). Four labelers
vote on every span, for, against or not at all:

* regex: the strict pattern and its check;
* gazetteer: known ends of domains, issuers of cards, area codes, address ranges;
* context: cue words in the 40 characters before;
* bounds: whether the span stands alone or within a longer word or number.

Expectation-maximisation over the counts of vote patterns estimates, for each kind, how many spans are personal and how reliable each labeler
is. Its posteriors are the soft labels of a logistic regression over votes and shape, fitted on the
counts of feature patterns, and candidates that it holds to be personal with probability ``LEAST`` or more are added. They
must not touch a base span, nor an added one that begins before.

All that reads texts is DataFrame functions; so is the training of the classifier. The driver sees counts of vote
patterns (at most 4 * 3 ** 4 rows) only.

Patterns use possessive repeats and look back where a run of characters begins, which finds the same matches as the plain form, leftmost and
without overlap, but never scans a run twice and needs no stack, however long it is.

Defined results: a null text is an empty one; a text without spans has zero counts, the digest of an empty string and an
empty list. Repeated rows get a row each. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordbase.llm.common import id_and_text
from wordbase.runtime import stored

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["regex", "gazetteer", "context", "bounds"]
LEAST = 0.9
EM_ROUNDS = 50
CONTEXT = 40

LOCAL = "[A-Za-z0-9._%+-]"
DOMAIN = "[A-Za-z0-9-]"
#: kind, whether it is the strict pattern, pattern, and a string a text must hold for the pattern to be tried
PATTERNS = [
    ("email", True, rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++", "@"),
    ("email", False, rf"(?:\G|(?<!{LOCAL})){LOCAL}++ ?[\[({{](?:at|AT)[\])}}] ?{DOMAIN}++(?: ?(?:\.|[\[({{](?:dot|DOT)[\])}}]) ?{DOMAIN}++)++", None),
    ("ip", True, r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+", "."),
    ("ip", False, r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", ":"),
    # runs of digits with single separators; only runs of the right length are of use
    ("card", True, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])", None),
    ("card", False, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12}+(?![ -]?[0-9])", None),
    ("phone", True, r"\+[0-9][ ().0-9-]+[0-9]", "+"),
    ("phone", False, r"(?<![0-9.+-])(?<![0-9] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", None),
]

# Ends of domains, and words that speak for or against a kind.
DOMAIN_ENDS = "com org net edu gov mil int io co info biz eu de fr es it uk us ca au ch at nl be se no dk fi pl pt br mx ar in jp cn kr ru".split()
CUES = {
    "email": "email e-mail mail contact write correo courriel",
    "ip": "ip host server address router gateway dirección adresse",
    "card": "card visa mastercard amex credit debit payment tarjeta carte karte",
    "phone": "phone tel telephone call fax mobile cell teléfono téléphone telefon",
}
AGAINST = "version isbn issn doi order serial sku token id ref hash part revision"


def _any_of(words: str) -> str:
    return r"(?i)(?<!\p{L})(?:" + "|".join(words.split()) + r")(?!\p{L})"


def _found(text: Column, kind: str, strict: bool, pattern: str, needs: str | None) -> Column:
    """An array of the matches of one pattern, with what lies before and after them.

    Marks around the matches turn the text into gaps and matches in turn.
    """
    pieces = F.split(F.regexp_replace(text, pattern, "\u0001$0\u0001"), "\u0001", -1)
    if needs:
        pieces = F.when(F.contains(text, F.lit(needs)), pieces)
    return pieces.alias(f"{kind}_{'strict' if strict else 'loose'}")


def _rows(name: str, kind: str, strict: bool) -> Column:
    """Structs of the matches in an array of gaps and matches."""
    p = F.col(name)

    def row(i: Column) -> Column:
        gap = F.get(p, i * 2 - 2)
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), i.cast("int").alias("n"),
            F.length(gap).alias("gap"), F.get(p, i * 2 - 1).alias("match"),
            F.substring(gap, -CONTEXT, CONTEXT).alias("before"), F.substring(F.get(p, i * 2), 1, 1).alias("after"),
        )

    none = F.lit(None).cast(f"array<{SPAN}>")
    return F.coalesce(F.when(F.size(p) > 2, F.transform(F.sequence(F.lit(1), F.expr(f"cast((size({name}) - 1) / 2 AS int)")), row)), none, F.expr(f"cast(array() AS array<{SPAN}>)"))


SPAN = "struct<kind: string, strict: boolean, n: int, gap: int, match: string, before: string, after: string>"


def _luhn() -> Column:
    """Whether the column ``digits`` has the check digit of a card number."""
    return F.expr(
        """aggregate(sequence(1, greatest(length(digits), 1)), 0, (sum, i) -> sum + (
             CASE WHEN i % 2 = 1 THEN try_cast(substring(digits, length(digits) + 1 - i, 1) AS int)
             ELSE try_cast(substring('0246813579', 1 + try_cast(substring(digits, length(digits) + 1 - i, 1) AS int), 1) AS int) END)) % 10 = 0"""
    )


def matches(docs: DataFrame) -> DataFrame:
    """Rows (row, doc_id, kind, strict, from, to, match, before, after); a row of kind null for each document."""
    texts = id_and_text(docs).withColumn("row", F.monotonically_increasing_id())
    # the mark itself must not occur; no pattern has it, and lengths stay
    marked = texts.withColumn("text", F.translate("text", "\u0001", "\u0002"))
    arrays = marked.select("row", "doc_id", *[_found(F.col("text"), *p) for p in PATTERNS])
    header = F.expr(f"array(cast(NULL AS {SPAN}))")
    every = F.concat(header, *[_rows(f"{k}_{'strict' if s else 'loose'}", k, s) for k, s, _, _ in PATTERNS])
    rows = arrays.select("row", "doc_id", F.explode(every).alias("span")).select("row", "doc_id", "span.*").repartition("row")
    up_to = Window.partitionBy("row", "kind", "strict").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(up_to)
    return rows.withColumn("to", end).withColumn("from", F.col("to") - F.length("match"))


def voted(found: DataFrame) -> DataFrame:
    """``matches`` with ``base``, the votes (1, -1 or 0) and the shape of each span."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    spans = found.withColumn("digits", digits)
    n = F.length("digits")
    parts = F.transform(F.split("match", r"\."), lambda x: F.ltrim(x, F.lit("0")))
    small = F.forall(parts, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255")))
    luhn = _luhn()
    passes = (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", n.between(14, 19) & luhn)
        .otherwise(n.between(10, 15))
    )
    base = F.col("strict") & passes

    def vote(plus: Column, minus: Column) -> Column:
        return F.when(plus, 1).when(minus, -1).otherwise(0)

    end = F.lower(F.regexp_extract("match", r"([A-Za-z]+)$", 1))
    first = F.regexp_extract("match", r"^0*([0-9]{1,3})", 1)
    area = F.substring(F.regexp_replace("digits", "^1(?=[0-9]{10}$)", ""), 1, 1)
    gazetteer = (
        F.when(F.col("kind") == "email", vote(end.isin(*DOMAIN_ENDS), F.lit(True)))
        .when(F.col("kind") == "card", vote(F.substring("digits", 1, 1).isin(*"3456"), F.lit(True)))
        .when(F.col("kind") == "ip", vote((first != "") & (F.length(first) < 3) | (first < "224"), first >= "224"))
        .otherwise(vote(area.isin(*"23456789"), F.lit(False)))
    )
    cue = F.coalesce(*[F.when(F.col("kind") == k, F.col("before").rlike(_any_of(words))) for k, words in CUES.items()])
    alone = ~F.substring("before", -1, 1).rlike(r"[\p{L}0-9_]") & ~F.col("after").rlike(r"[\p{L}0-9_]")
    return spans.select(
        "row", "doc_id", "kind", "strict", "from", "to", F.coalesce(base, F.lit(False)).alias("base"),
        F.when(F.col("strict"), vote(passes, F.lit(True))).when(F.col("kind") == "card", vote(luhn, F.lit(True))).otherwise(0).alias("regex"),
        F.coalesce(gazetteer, F.lit(0)).alias("gazetteer"),
        vote(cue, F.col("before").rlike(_any_of(AGAINST))).alias("context"),
        vote(alone, F.lit(True)).alias("bounds"),
        F.least(n, F.lit(20)).alias("n_digits"),
        F.col("match").rlike("[ ()-]").cast("int").alias("parted"),
    )


def reliabilities(counts: list[tuple[tuple[int, ...], float]]) -> dict[tuple[int, ...], float]:
    """The probability of being personal for each vote pattern of one kind, by expectation-maximisation.

    Two classes; given the class, labelers vote independently. Votes for start out as right in four of five cases,
    and one count of each vote is added, so that a labeler that never votes says nothing.
    """
    prior, like = 0.5, {c: [{v: 0.6 if v == (1 if c else -1) else 0.25 if v == 0 else 0.15 for v in (-1, 0, 1)} for _ in LABELERS] for c in (0, 1)}
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(EM_ROUNDS):
        for votes, _n in counts:
            yes, no = (math.log(p) + sum(math.log(like[c][i][v]) for i, v in enumerate(votes)) for c, p in ((1, prior), (0, 1 - prior)))
            posterior[votes] = 1 / (1 + math.exp(min(500, no - yes)))
        total = sum(n for _, n in counts)
        share = sum(n * posterior[v] for v, n in counts)
        prior = (share + 1) / (total + 2)
        for c in (0, 1):
            for i in range(len(LABELERS)):
                seen = {v: 1.0 for v in (-1, 0, 1)}
                for votes, n in counts:
                    seen[votes[i]] += n * (posterior[votes] if c else 1 - posterior[votes])
                like[c][i] = {v: s / sum(seen.values()) for v, s in seen.items()}
    return posterior


def _features() -> list[Column]:
    votes = [F.expr(f"cast({x} = {v} AS double)").alias(f"{x}_{'for' if v == 1 else 'against'}") for x in LABELERS for v in (1, -1)]
    kinds = [F.expr(f"cast(kind = '{k}' AS double)").alias(f"is_{k}") for k in KINDS[1:]]
    return [*votes, *kinds, (F.col("n_digits") / 20).alias("n_digits_of_20"), F.col("parted").cast("double").alias("is_parted")]


def classifier(spans: DataFrame) -> Column | None:
    """The probability of being personal, as a column over the columns of ``voted``; none if there are no spans."""
    spark = spans.sparkSession
    shape = ["kind", *LABELERS, "n_digits", "parted"]
    patterns = stored(spans.groupBy(*shape).count(), "patterns")
    counts: dict[str, list[tuple[tuple[int, ...], float]]] = {}
    for r in patterns.groupBy("kind", *LABELERS).agg(F.sum("count").alias("n")).collect():
        counts.setdefault(r["kind"], []).append((tuple(r[x] for x in LABELERS), float(r["n"])))
    if not counts:
        return None
    labels = [(k, *votes, p) for k, c in counts.items() for votes, p in reliabilities(c).items()]
    soft = spark.createDataFrame(labels, f"kind string, {', '.join(f'{x} int' for x in LABELERS)}, p double")
    both = patterns.join(soft, ["kind", *LABELERS])
    rows = both.withColumn("label", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).withColumn(
        "weight", F.col("count") * F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p"))
    )
    features = _features()
    names = [f"f{i}" for i in range(len(features))]
    table = rows.select("label", "weight", *[f.alias(n) for f, n in zip(features, names, strict=True)])
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(table).coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50, standardization=False).fit(vectors)
    value = F.lit(float(model.intercept))
    for f, w in zip(features, model.coefficients.toArray().tolist(), strict=True):
        value = value + f * F.lit(w)
    return 1 / (1 + F.exp(-value))


def find_spans(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """A row for each document: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of base spans, spans of all spans.

    Spans are written ``kind:from:to`` in code points, comma-joined, by start and then in the order of ``KINDS``. More columns:
    n_added, and ``added``, the added spans alone.
    """
    table = stored(voted(matches(docs)), "spans")
    spans = table.where("kind IS NOT NULL")
    personal = classifier(spans)
    chance = F.lit(0.0) if personal is None else personal
    # a loose match of what the strict pattern found is no candidate, as they touch
    kept = table.withColumn("added", F.coalesce(~F.col("base") & (chance >= least), F.lit(False))).where("kind IS NULL OR base OR added")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    ahead = Window.partitionBy("row").orderBy("from").rangeBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("row").orderBy("from").rangeBetween(0, Window.unboundedFollowing)
    earlier = Window.partitionBy("row").orderBy("from", "order", "to", "strict").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        kept.withColumn("order", order)
        .repartition("row")
        .withColumn("last_base", F.max(F.when(F.col("base"), F.col("to"))).over(ahead))
        .withColumn("next_base", F.min(F.when(F.col("base"), F.col("from"))).over(behind))
        .withColumn("free", F.col("added") & (F.coalesce("last_base", F.lit(-1)) <= F.col("from")) & F.coalesce(F.col("next_base") >= F.col("to"), F.lit(True)))
        .withColumn("last_added", F.max(F.when(F.col("free"), F.col("to"))).over(earlier))
        .withColumn("free", F.col("free") & (F.coalesce("last_added", F.lit(-1)) <= F.col("from")))
        .where("kind IS NULL OR base OR free")
    )
    entry = F.struct("from", "order", "to", F.concat_ws(":", "kind", "from", "to").alias("span"))

    def listed(which: Column) -> Column:
        entries = F.sort_array(F.collect_list(F.when(which, entry)))
        return F.array_join(F.transform(entries, lambda x: x["span"]), ",")

    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS]
    return placed.groupBy("row", "doc_id").agg(
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("kind").isNotNull()).alias("spans"),
        F.count(F.when(F.col("free"), 1)).alias("n_added"),
        listed(F.col("free")).alias("added"),
    ).drop("row")
