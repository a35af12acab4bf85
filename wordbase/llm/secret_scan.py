"""Secrets in every version of every file, by a ledger of scanned contents that only grows.

A version's text is addressed by its content (SHA-256). The ledger has a row for each content and scan, with the rules, by version, that
were run on it and what they found, so a content without findings is known too. A scan lists the contents of all versions, takes off the
pairs of content and rule version that the ledger has, runs what is left, one copy of each content and only the rules it lacks, appends
the outcome, and joins the findings back to all paths that have the content. A new rule or a new version of a rule is run over old
contents alone; a new path to an old content, or a version that comes back, costs a hash.

How it runs: DataFrame functions only. Texts are hashed in one pass and scanned in a second one. The rows to scan, or if these are more the rows to
leave out, are written first, so that Spark knows their size and moves texts only where both lists are long. What a rule matches never leaves
the task that found it: rows of places and lengths are shuffled, no secret is. A content held by many paths is joined in pieces.

Rules are patterns of Java, whose matches are taken leftmost and without overlap, and a check; a match that fails it is dropped and
not tried again. Patterns do not back up over long runs and need no stack. ``BASE`` are the rules of the contract; ``ADDED`` finds
further kinds: private key blocks, signed web tokens, keys whose makers gave them a prefix, and passwords in addresses.

Defined results: a null text is an empty one. Repeated rows get a row each. A text without findings has zero counts, the digest of an empty string and
an empty list. An empty table gives no rows. Other columns are not looked at. The table is read twice and must give the same rows in the same order, as
files do; anything else has to be written first.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordbase.llm.common import id_and_text
from wordbase.operators.keyed import spread_join
from wordbase.runtime import scratch_path, stored

MARK = "\u0001"  #: stands around matches; texts have another control character in its place


class Rule(NamedTuple):
    kind: str
    version: str
    pattern: str
    check: Callable[[Column], Column] | None = None
    needs: tuple[str, ...] = ()  #: strings of which a text must hold one

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = (
    "(" + "|".join(map(_either_case, ["password", "passwd", "secret", "token", "api_?key"])) + ")"
    "[\"']?+\\x20*+[:=]\\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)"
)

BASE = [
    Rule("assign", "1", ASSIGN, lambda match: F.length(F.regexp_extract(match, ASSIGN, 2)) >= 8),
    Rule("access", "1", "AKIA[A-Z0-9]++", lambda match: F.length(match) >= 16, ("AKIA",)),
    Rule("hex", "1", "[0-9a-f]{32,}+"),
]

# The forms in which keys and tokens of well-known kinds are written.
ADDED = [
    Rule("pem", "1", "-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY(?: BLOCK)?-----", None, ("-----BEGIN ",)),
    Rule("jwt", "1", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", None, ("eyJ",)),
    Rule(
        "prefixed", "1",
        "(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{16,}+|AIza[A-Za-z0-9_-]{35}"
        "|sk_live_[A-Za-z0-9]{16,}+|glpat-[A-Za-z0-9_-]{20,}+)",
        None, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "AIza", "sk_live_", "glpat-"),
    ),
    Rule("address", "1", r"(?<=://)[^ \t\n\x0B\f\r/:@]{1,64}+:[^ \t\n\x0B\f\r/:@]{4,128}+@", None, ("://",)),
]
RULES = BASE + ADDED

FINDING = "struct<rule: string, start: long, end: long>"
LEDGER = f"blob binary, rules array<string>, findings array<{FINDING}>"
SPAN = "struct<rule: string, n: int, gap: int, length: int>"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the ledger in a folder; none if nothing was written there yet."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def _pieces(text: Column, rule: Rule) -> Column:
    """The gaps and matches of a rule in turn; null without a match or where the rule is not due."""
    due = F.array_contains("rules", rule.id)
    if rule.needs:
        due = due & F.coalesce(*[F.when(F.contains(text, F.lit(s)), True) for s in rule.needs], F.lit(False))
    marked = F.regexp_replace(text, rule.pattern, f"{MARK}$0{MARK}")
    return F.when(due & F.rlike(text, F.lit(rule.pattern)), F.split(marked, MARK, -1)).alias(rule.kind)


def _spans(rule: Rule) -> Column:
    """Of gaps and matches the number, the length before and the own length of each match; length is below 0 if the check fails."""
    p = F.col(rule.kind)

    def span(i: Column) -> Column:
        match = F.get(p, i * 2 - 1)
        gap = F.length(F.get(p, i * 2 - 2))
        length = F.length(match)
        good = F.lit(True) if rule.check is None else rule.check(match)
        return F.struct(F.lit(rule.id).alias("rule"), i.alias("n"), gap.alias("gap"), F.when(good, length).otherwise(-length).alias("length"))

    last = F.expr(f"cast((size({rule.kind}) - 1) / 2 AS int)")
    none = F.expr(f"cast(array() AS array<{SPAN}>)")
    return F.coalesce(F.when(F.size(p) > 2, F.transform(F.sequence(F.lit(1), last), span)), none)


def matches(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Of ``texts`` (row, text, rules: the ids of those due) a row (row, findings) for each text that has any."""
    marked = texts.withColumn("text", F.translate("text", MARK, "\u0002"))
    arrays = marked.select("row", *[_pieces(F.col("text"), r) for r in rules])
    spans = arrays.select("row", F.explode(F.concat(*map(_spans, rules))).alias("span")).select("row", "span.*")
    up_to = Window.partitionBy("row", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.abs("length")).over(up_to)
    placed = spans.repartition("row").withColumn("end", end).where("length > 0").withColumn("start", F.col("end") - F.col("length"))
    return placed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rule", "start", "end"))).alias("findings"))


def scan(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``versions`` (text, and other columns for the path): returns the versions without their texts,
    with ``blob``, the address of the content."""
    if len({r.kind for r in rules}) < len(rules):
        raise ValueError("two rules of one kind")
    spark = versions.sparkSession
    text = F.coalesce(versions["text"], F.lit(""))
    numbered = versions.withColumn("text", text).withColumn("row", F.monotonically_increasing_id())
    address = F.unhex(F.sha2("text", 256))
    listing = stored(numbered.withColumns({"blob": address, "check": F.xxhash64("text")}).drop("text"), "versions")

    every = F.array(*[F.lit(r.id) for r in rules])
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known"))
    contents = listing.groupBy("blob").agg(F.min(F.struct("row", "check")).alias("copy"))
    due = F.array_except(every, F.coalesce("known", F.expr("cast(array() AS array<string>)")))
    due = contents.join(known, "blob", "left").select("blob", "copy.*", due.alias("rules")).where(F.size("rules") > 0)
    todo = stored(due, "todo")
    n_todo, whole = todo.agg(F.count("*"), F.count(F.when(F.size("rules") == len(rules), 1))).first()
    if n_todo:
        source = numbered.select("row", "text")
        if whole == n_todo and listing.count() < 2 * n_todo:
            rest = stored(listing.select("row").join(todo.select("row"), "row", "left_anti"), "copies")
            texts = source.join(rest, "row", "left_anti").withColumn("rules", every)
        else:
            changed = F.raise_error(F.lit("a text changed while it was scanned")).cast("array<string>")
            texts = source.join(todo.select("row", "check", "rules"), "row").withColumn(
                "rules", F.when(F.xxhash64("text") == F.col("check"), F.col("rules")).otherwise(changed)
            )
        found = matches(texts.select("row", "text", "rules"), rules)
        new = todo.join(found, "row", "left")
        findings = F.coalesce("findings", F.expr(f"cast(array() AS array<{FINDING}>)"))
        new.select("blob", "rules", findings.alias("findings")).write.mode("append").parquet(ledger)
    return listing.drop("row", "check")


def findings(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """For each content of ``versions`` (blob) that has any, the findings of these rules, by place."""
    now = F.array(*[F.lit(r.id) for r in rules])
    held = read_ledger(versions.sparkSession, ledger).where(F.size("findings") > 0).select("blob", F.explode("findings").alias("finding"))
    held = held.where(F.array_contains(now, F.col("finding.rule"))).distinct()
    order = F.array_position(now, F.col("finding.rule"))
    entry = F.struct("finding.start", order.alias("order"), "finding.end", F.split_part("finding.rule", F.lit("@"), F.lit(1)).alias("kind"))
    by_blob = held.groupBy("blob").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    return by_blob.join(versions.select("blob").distinct(), "blob", "left_semi")


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """A row for each document: doc_id, n_assign, n_access, n_hex and base_sha256 of the base spans, spans of all spans.

    Spans are written ``kind:start:end`` in code points, comma-joined, by start and then in the order of ``RULES``. ``ledger`` is a folder
    that outlives the run; without one everything is new.
    """
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    paths = scan(id_and_text(docs), ledger)
    base = [r.kind for r in BASE]

    def listed(entries: Column) -> Column:
        return F.array_join(F.transform(entries, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda x: x["kind"].isin(*kinds))

    by_blob = findings(paths, ledger).select(
        "blob",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )
    joined = spread_join(paths, stored(by_blob, "findings"), "blob", "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in base],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
