"""Repeated lines, equal or a few edits apart, by a segment-partition edit join.

Each line is cut into ``threshold + 1`` even segments. Of a line within ``threshold`` edits, at least one segment is
left whole and stands near its old place. So every line is indexed by its segments, by length, number and content,
and looks up those of its substrings that the lengths and places allow: lines of its own length and shorter
ones, from which the longer is found. Lines that meet are verified by a banded bit-parallel edit distance.

How it runs: texts of lines are not shuffled but for the few that meet another. One pass reduces all index and look-up rows to
one entry for each content, combined before the shuffle, to see where different lines meet. A
bitmap of fixed size tells the second pass which rows to make with their text; it only saves
shuffling, as rows it lets through in vain meet nobody.

A list of more than ``LONG_LIST`` lines is not paired. With one edit allowed, its lines are linked through what is left
of them when one character is taken out: equal remains at the same place, or remains that equal a line. Each line
then hangs to the first of such a group; this is exact too, and costs the length of a line, not the square of
the list. Lines beyond ``LONG_LINE`` characters (one character more is in both steps), and lists with higher thresholds, are always paired.

Lines linked by a chain of edits, and equal ones, are a class; its first line, by doc_id, row and place, stays.
A line without any visible character is never a copy. A line shorter than ``LEAST_CHARS`` is a copy of equal ones only.

Defined results: a null or empty text has one empty line, which stays. Repeated rows are documents of their own,
so lines of the second are copies. A null id comes last. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.llm.common import components, id_and_text
from wordbase.runtime import stored

THRESHOLD = 1
LEAST_CHARS = 20
LONG_LIST = 64
LONG_LINE = 2000
BITMAP_BITS = 23


def _lines(docs: DataFrame, *names: str) -> DataFrame:
    split = F.posexplode(F.split(docs["text"], "\n", -1)).alias("line_no", "line")
    return docs.select(*names, split)


def _visible() -> Column:
    return F.col("line").rlike("[^ \\t\\r\\x0B\\f]")


def segment(length: Column, number: int, threshold: int) -> tuple[Column, Column]:
    """Start (from 0) and size of a segment of a line of this length; the last ones take what is left over."""
    parts = threshold + 1
    base, over = F.floor(length / parts), length % parts
    return base * number + F.greatest(F.lit(0), over - (parts - number)), base + (F.lit(number) >= parts - over).cast("int")


def look_ups(threshold: int) -> list[tuple[int, int, int]]:
    """(how much shorter, segment, shift): the substrings that may be whole segments of a line within the threshold.

    Left of segment ``i`` there are at most ``i`` edits that matter and right of it the others, which bounds the shift.
    The segments of the line itself are not among them.
    """
    return [
        (less, i, shift)
        for less in range(threshold + 1)
        for i in range(threshold + 1)
        for shift in range(max(-i, less - (threshold - i)), min(i, less + (threshold - i)) + 1)
        if less or shift
    ]


def _entries(threshold: int) -> Column:
    """An array of (sig, index) for ``line`` of ``n`` characters: index entries and look-ups."""
    entries = []
    for less, i, shift in [(0, i, 0) for i in range(threshold + 1)] + look_ups(threshold):
        length = F.col("n") - less
        start, size = segment(length, i, threshold)
        sig = F.xxhash64(F.lit(i), length, F.substring(F.col("line"), (start + shift + 1).cast("int"), size.cast("int")))
        inside = (start + shift >= 0) & (start + shift + size <= F.col("n"))
        entry = F.struct(sig.alias("sig"), F.lit(not less and not shift).alias("index"))
        entries.append(F.when(inside, entry) if less or shift else entry)
    return F.array_compact(F.array(*entries))


def within(x: Column, y: Column, threshold: int) -> Column:
    """Whether two strings are within so many edits: a banded bit-parallel automaton.

    Bit ``k`` of level ``e`` says that the first ``j`` characters of ``y`` and the first ``j + k - threshold`` of
    ``x`` are ``e`` edits apart at most. Only the band of ``2 * threshold + 1`` bits around the diagonal is kept; a step
    takes one character of ``y`` for the whole band.
    """
    t, band = threshold, (1 << (2 * threshold + 1)) - 1

    def chars(s: Column) -> Column:
        return F.split(s, "")

    def levels(values: list[Column]) -> Column:
        return F.struct(*[v.alias(f"e{e}") for e, v in enumerate(values)])

    def run(both: Column) -> Column:
        def step(state: Column, j: Column) -> Column:
            char = F.get(both["y"], j)
            same = [F.coalesce(F.get(both["x"], j + (k - t)) == char, F.lit(False)).cast("int") * (1 << k) for k in range(2 * t + 1)]
            match = same[0]
            for bit in same[1:]:
                match = match + bit
            new: list[Column] = []
            for e in range(t + 1):
                value = state[f"e{e}"].bitwiseAND(match)
                if e:
                    less = state[f"e{e - 1}"]
                    value = value.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(new[-1], 1))
                    value = value.bitwiseAND(F.lit(band))
                new.append(value)
            # nothing comes back once no bit is left
            return F.when(state[f"e{t}"] == 0, state).otherwise(levels(new))

        first = levels([F.lit(sum(1 << (t + i) for i in range(e + 1))) for e in range(t + 1)])
        last = F.aggregate(F.sequence(F.lit(0), F.size(both["y"]) - 1), first, step)
        end = F.shiftright(last[f"e{t}"], 0)
        bit = F.size(both["x"]) - F.size(both["y"]) + t
        return F.when(bit.between(0, 2 * t), F.element_at(F.array(*[F.shiftright(end, k).bitwiseAND(F.lit(1)) for k in range(2 * t + 1)]), bit + 1) == 1).otherwise(False)

    # the arrays are made once and bound, not once for each step
    pair = F.array(F.struct(chars(x).alias("x"), chars(y).alias("y")))
    return F.element_at(F.transform(pair, run), 1)


def _bitmap(sigs: DataFrame) -> Column:
    """Which low bits the live contents have, as one value: an array of 2 ** 17 numbers."""
    low = F.col("sig").bitwiseAND((1 << BITMAP_BITS) - 1)
    words = sigs.groupBy(F.shiftright(low, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(sig & 63 AS int))")).alias("bits"))
    every = sigs.sparkSession.range(1 << (BITMAP_BITS - 6)).withColumnRenamed("id", "word").join(words, "word", "left")
    entries = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return stored(every.agg(F.transform(entries, lambda x: x["bits"]).alias("words")), "bitmap").scalar()


def line_links(texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) between hashes of different lines within ``threshold`` edits, enough to connect all that are."""
    long = _lines(texts).withColumn("n", F.length("line")).where((F.col("n") >= LEAST_CHARS) & _visible())
    made = long.select(F.xxhash64("line").alias("a"), "line", "n", F.explode(_entries(threshold)).alias("entry"))
    rows = made.select("a", "entry.sig", "entry.index", "line", "n")
    seen = rows.groupBy("sig").agg(F.min("a").alias("low"), F.max("a").alias("high"), F.max(F.col("index").cast("int")).alias("index"))
    live = stored(seen.where("low < high AND index = 1").select("sig"), "live")
    if live.isEmpty():
        return texts.sparkSession.createDataFrame([], "a long, b long")
    words = _bitmap(live)
    word = F.shiftright(F.col("sig").bitwiseAND((1 << BITMAP_BITS) - 1), 6)
    hit = F.get(words, word.cast("int")).bitwiseAND(F.expr("shiftleft(1L, cast(sig & 63 AS int))")) != 0
    lists = stored(rows.where(hit).groupBy("sig", "index", "a", "line", "n").agg(F.lit(1).alias("one")).drop("one"), "lists")
    sizes = lists.groupBy("sig").count()
    paired, links = lists, None
    if threshold == 1:
        long_lists = stored(sizes.where(F.col("count") > LONG_LIST).select("sig"), "long_lists")
        short = F.col("n") <= LONG_LINE
        # lines just over the border too, as the pairing does not compare them with those below
        crowd = lists.where(F.col("n") <= LONG_LINE + threshold).join(long_lists, "sig", "left_semi").select("a", "line", "n").distinct()
        links = _crowd_links(stored(crowd, "crowd"))
        paired = lists.where(~short).union(lists.where(short).join(long_lists, "sig", "left_anti"))
    x = paired.where("index").select("sig", F.col("a").alias("xa"), F.col("line").alias("x"))
    y = paired.select("sig", "index", F.col("a").alias("ya"), F.col("line").alias("y"))
    once = (~F.col("index") | (F.col("xa") < F.col("ya"))) & (F.col("xa") != F.col("ya"))
    near = x.join(y, "sig").where(once & within(F.col("x"), F.col("y"), threshold)).select(F.col("xa").alias("a"), F.col("ya").alias("b"))
    return near if links is None else near.union(links)


def _crowd_links(lines: DataFrame) -> DataFrame:
    """Links of lines (a, line, n) one edit apart, by what is left of them without one character."""
    place = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("place")
    cut = lines.select("a", "line", "n", place).select(
        "a", "n", "place", F.xxhash64(F.concat(F.expr("substring(line, 1, place - 1)"), F.expr("substring(line, place + 1)"))).alias("rest")
    )
    same = cut.groupBy("rest", "n", "place").agg(F.min("a").alias("b"), F.max("a").alias("high")).where("b < high").drop("high")
    changed = cut.join(same, ["rest", "n", "place"]).where("a <> b").select("a", "b")
    longer = cut.join(lines.select(F.xxhash64("line").alias("rest"), F.col("a").alias("b"), (F.col("n") + 1).alias("n")), ["rest", "n"]).select("a", "b")
    links = changed.union(longer).distinct()
    x = lines.select("a", F.col("line").alias("x"))
    y = lines.select(F.col("a").alias("b"), F.col("line").alias("y"))
    return links.join(x, "a").join(y, "b").where(within(F.col("x"), F.col("y"), 1)).select("a", "b")


def _numbered(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("row", F.monotonically_increasing_id())


def line_classes(texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Of texts (row, doc_id, text) a row for each line: row, doc_id, line_no, and class_doc, class_row and class_line
    of the first line of its class."""
    places = _lines(texts, "row", "doc_id").select(
        "row", "doc_id", "line_no", F.when(_visible(), F.xxhash64("line")).alias("a"), F.xxhash64(F.lit(1), "line").alias("check")
    )
    places = stored(places, "lines")
    order = F.struct(F.isnull("doc_id").alias("null"), "doc_id", "row", "line_no")
    firsts = places.where("a IS NOT NULL").groupBy("a", "check").agg(F.min(order).alias("first"))
    roots = components(line_links(texts, threshold)).withColumnRenamed("node", "a")
    joined = stored(firsts.join(roots, "a", "left"), "firsts")
    heads = joined.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("head"))
    # most lines have no link and no root; they do not take part in the join, where they would be one key
    linked = joined.join(heads, "root").select("a", "check", "head")
    classes = linked.union(joined.where("root IS NULL").select("a", "check", F.col("first").alias("head")))
    found = places.where("a IS NOT NULL").join(classes, ["a", "check"]).select("row", "doc_id", "line_no", "head")
    alone = places.where("a IS NULL").select("row", "doc_id", "line_no", order.alias("head"))
    return found.union(alone).select(
        "row", "doc_id", "line_no",
        F.col("head.doc_id").alias("class_doc"), F.col("head.row").alias("class_row"), F.col("head.line_no").alias("class_line"),
    )


def _by_document(texts: DataFrame, threshold: int) -> DataFrame:
    own = (F.col("row") == F.col("class_row")) & (F.col("line_no") == F.col("class_line"))
    gone = F.when(~own, F.struct("line_no", "class_doc", "class_line"))
    return line_classes(texts, threshold).groupBy("row", "doc_id").agg(
        F.count("*").alias("n_lines"), F.count(F.when(own, 1)).alias("n_kept"), F.sort_array(F.collect_list(gone)).alias("dropped")
    )


def line_report(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """A row for each document: doc_id, n_lines, n_kept, and ``dropped``: its lines that go, with the line that stays for each."""
    return _by_document(_numbered(docs), threshold).drop("row")


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, text) of all documents, without the lines that go."""
    texts = stored(_numbered(docs), "texts")
    gone = _by_document(texts, threshold).select("row", F.col("dropped.line_no").alias("gone"))
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("gone", i))
    return texts.join(gone, "row").select("doc_id", F.array_join(kept, "\n").alias("text"))
