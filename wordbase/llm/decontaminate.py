"""Benchmark passages in documents, found by template windows, also where numbers, names or units were changed.

Words become template words: numbers, units after a number, and names turn into placeholders of their type; others are lower-cased
without the punctuation around them. Windows of ``WINDOW`` words of documents and of benchmark items are joined on their
hash, as templates and word for word. A template match only counts if its slots agree: along one
alignment of document and item, equal values of the item stand for equal values of the document and the other way
round. A document is contaminated by an item if at least ``SHARE`` of the item's windows are found in it, or windows one after
the other that make up ``RUN`` words. In scripts without spaces between words each character is a word.

A capitalised word that is not listed may be a name or not, so there are three readings of a text: all such words are names, all
but those at the start of a sentence, or none. An alignment holds in one of them. Numbers are parted from what is glued to them (``5km``, ``5-year-old``); ``twenty-five`` is one number.

How it runs: documents are read once, by map tasks, which keep only windows that a bitmap of all item windows may know. The
bitmap has a fixed size, whatever the size of the benchmark; it only saves shuffling. The join on hashes is Spark's,
so a passage found in many documents is a hot key of a plain join, which Spark splits.

A template window with fewer than ``LITERALS`` words of its own only counts where the whole item is found along the alignment.
One of slots alone says nothing, and its hash would be that of any table of numbers: it is never joined. Runs of slots that are that long
are kept whole. Where all other windows of an item are found along an alignment, its runs are looked up at the places they must have in the
document, by one row for each run, and their types and values compared.

An item of slots alone has no templates, nor has one with fewer than ``LITERALS`` words left where sentence starts are names. An
item of fewer words than a window is one window of its length; one of fewer than ``LEAST_WORDS`` words is found word for word only.
Items with the same words are found together, under the smallest id.

Defined results: null and empty texts hold nothing. Documents are told apart by id and text, so equal rows are one. An
empty table or benchmark gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.llm.common import arrow_rows, id_and_text, without_rows
from wordbase.runtime import stored

WINDOW = 8
LITERALS = 3
LEAST_WORDS = 4
SHARE = 0.5
RUN = 50
BITMAP_BITS = 23
PLAIN, STARTS_ARE_WORDS, STARTS_ARE_NAMES, ALL_ARE_WORDS = range(4)  #: word for word, and the readings of templates
KNOWN_WORDS = 300_000  #: words a worker remembers before it starts anew

# Words that are numbers, units and given names.
NUMBERS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split()
UNITS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce ounces ton
tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months
year years cent cents dollar dollars euro euros usd eur percent degree degrees mph kmh watt watts volt volts""".split()
NAMES = """Alice Amy Anna Anne Ben Bob Carlos Charles Claire David Diego Emily Emma Eric Frank George Hans Henry Jack James
Jane Janet Jean John Jose Julia Karen Kate Laura Lisa Lucy Luis Maria Mark Mary Max Michael Nancy Natalia Paul Peter Pierre
Robert Sam Sarah Sophie Susan Tom Weng William""".split()

LITERAL, NUMBER, UNIT, CAPITAL, NAME, BLANK = range(6)
_BREAK = "\x1e"  # stands for a line break among the words
_AROUND = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"\d(?:[\d.,:/-]*\d)?(?:st|nd|rd|th)?")
#: Thai, Lao, Burmese, Khmer, kana and ideographs.
_UNSPACED = re.compile("[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_SENTENCE_END = re.compile(r"[.!?:][^\w]*$")
_GLUED = re.compile(r"([\W_]*\d(?:[\d.,:/-]*\d)?)(-?)([^\W\d_].*)", re.DOTALL)
_END_MARKS = ".!?:"
_MARKS = _END_MARKS + ",;"
_SETS = frozenset(NUMBERS), frozenset(UNITS), frozenset(NAMES)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


def parted(word: str) -> tuple[str, str]:
    """A word that begins with a number, and what is glued to it: a unit, or anything after a hyphen."""
    glued = _GLUED.fullmatch(word)
    if glued and (glued[2] or _AROUND.sub("", glued[3]).lower() in _SETS[1]):
        return glued[1], glued[3]
    if "-" in word:
        parts = word.split("-")
        numbers = 0
        while numbers < len(parts) and _AROUND.sub("", parts[numbers]).lower() in _SETS[0]:
            numbers += 1
        rest = "-".join(parts[numbers:])
        if numbers and _AROUND.sub("", rest):
            return "-".join(parts[:numbers]), rest
    return word, ""


def classify(word: str) -> tuple[int, int, bool]:
    """Kind, hash and whether a sentence may begin after it, of a word as it stands in a text."""
    numbers, units, names = _SETS
    if word == _BREAK:
        return BLANK, 0, True
    bare = _AROUND.sub("", word)
    ends = bool(_SENTENCE_END.search(word))
    low = bare.lower()
    if not bare:
        return BLANK, 0, ends
    if _NUMBER.fullmatch(bare) or low in numbers or "-" in low and numbers.issuperset(low.split("-")):
        kind = NUMBER
    elif low in units:
        kind = UNIT
    elif bare in names:
        kind = NAME
    elif bare[0].isupper() and bare[1:].islower():
        kind = CAPITAL
    else:
        kind = LITERAL
    return kind, _hash(low), ends


class _Known(dict):
    """The numbers of words; a word that is not known yet is classified. Kinds, hashes, ends and what is glued to a word (its
    number, or -1) are arrays by number."""

    def __init__(self) -> None:
        super().__init__()
        self.kind, self.hash, self.ends, self.glued = (np.zeros(1024, t) for t in (np.int8, np.uint64, bool, np.int64))

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        if number == len(self.kind):
            arrays = self.kind, self.hash, self.ends, self.glued
            self.kind, self.hash, self.ends, self.glued = (np.concatenate([x, np.zeros_like(x)]) for x in arrays)
        # most words are letters, with one mark after them at most: nothing is glued to these
        letters = word if word.isalpha() else word[:-1] if word[-1] in _MARKS and word[:-1].isalpha() else ""
        if letters:
            low = letters.lower()
            numbers, units, names = _SETS
            self.hash[number] = xxhash.xxh64_intdigest(low.encode())
            self.ends[number] = word[-1] in _END_MARKS
            self.kind[number] = (
                NUMBER if low in numbers else UNIT if low in units else NAME if letters in names
                else CAPITAL if letters[0].isupper() and letters[1:].islower() else LITERAL
            )
            self.glued[number] = -1
            return number
        head, rest = parted(word)
        self.kind[number], self.hash[number], self.ends[number] = classify(head)
        after = self[rest] if rest else -1
        self.glued[number] = after
        return number


class Canon:
    """Words to template words, for one worker."""

    def __init__(self) -> None:
        self.known = _Known()
        self.slots = np.array([_hash(f"<{k}>") for k in range(6)], np.uint64)

    def __call__(self, text: str) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Literal hashes of the words of a text; and for each reading template hashes and whether a word is a slot."""
        if len(self.known) > KNOWN_WORDS:
            self.known = _Known()
        known = self.known
        if not text.isascii():
            text = _UNSPACED.sub(r" \g<0> ", text)
        words = text.replace("\n", f" {_BREAK} ").split()
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        heads = np.flatnonzero(known.glued[at] >= 0)
        while len(heads):
            at = np.insert(at, heads + 1, known.glued[at[heads]])
            heads = heads + 1 + np.arange(len(heads))  # where the inserted words are
            heads = heads[known.glued[at[heads]] >= 0]
        kind, own, ends = known.kind[at], known.hash[at], known.ends[at]
        first = np.concatenate([[True], ends[:-1]])[: len(at)]
        # punctuation alone and line breaks pass on what came before them
        solid = kind != BLANK
        for i in np.flatnonzero(~solid):
            if i + 1 < len(first):
                first[i + 1] |= first[i]
        kind, own, first = kind[solid], own[solid], first[solid]
        after_number = np.concatenate([[False], kind[:-1] == NUMBER])[: len(kind)]
        kind = np.where((kind == UNIT) & ~after_number, LITERAL, kind)
        readings = {}
        for reading, words in ((STARTS_ARE_WORDS, first), (STARTS_ARE_NAMES, False), (ALL_ARE_WORDS, True)):
            typed = np.where(kind == CAPITAL, np.where(words, LITERAL, NAME), kind)
            slot = typed != LITERAL
            readings[reading] = np.where(slot, self.slots[typed], own), slot
        return own, readings


def _windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each window."""
    n = len(hashes) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[i : i + n]
    return total ^ (total >> np.uint64(29))


def windows(canon: Canon, text: str, widths: list[int]):
    """(hashes, how they were read, places and slots, width) of the windows of a text; slots are hashes of values, 0 for words."""
    own, readings = canon(text)
    for width in widths:
        if len(own) < width:
            continue
        yield _windows(own, width), PLAIN, None, width
        if width < LEAST_WORDS:
            continue
        for reading, (template, slot) in readings.items():
            # windows with a slot and with a word
            filled = np.cumsum(np.concatenate([[0], slot]))
            n_slots = filled[width:] - filled[:-width]
            use = np.flatnonzero((n_slots > 0) & (n_slots < width))
            if len(use):
                values = np.where(slot, own | np.uint64(1), np.uint64(0))
                yield _windows(template, width)[use], reading, (use, values), width


def slot_runs(canon: Canon, text: str, least: int):
    """(reading, start, types, values, whether a word stands before it) of the longest runs of slots that have ``least`` or more."""
    own, readings = canon(text)
    for reading, (template, slot) in readings.items():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], slot.astype(np.int8), [0]])))
        for start, stop in edges.reshape(-1, 2).tolist():
            if stop - start >= least:
                yield reading, start, template[start:stop].view(np.int64).tolist(), (own[start:stop] | np.uint64(1)).view(np.int64).tolist(), start > 0


RUNS = "template int, at int, types array<long>, slots array<long>, after_word boolean"
_RUN_TYPES = {"template": pa.int32(), "at": pa.int32(), "types": pa.list_(pa.int64()), "slots": pa.list_(pa.int64()), "after_word": pa.bool_()}
WINDOWS = "h long, template int, at int, slots array<long>"


def _slots(values: np.ndarray, at: int, width: int) -> list[int]:
    part = values[at : at + width]
    return part[part != 0].view(np.int64).tolist()


def _arrays(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in types.items()], names=list(types))


_TYPES = {"h": pa.int64(), "template": pa.int32(), "at": pa.int32(), "slots": pa.list_(pa.int64())}


def _item_words(canon: Canon, text: str, width: int) -> tuple[int, int, list[int]]:
    """How many words a window of an item has (none: 0), a hash of the item's words, and the readings in which it has templates."""
    own, readings = canon(text)
    literals = {reading: np.count_nonzero(~slot) for reading, (_, slot) in readings.items()}
    using = [r for r, n in literals.items() if n >= (LITERALS if r == STARTS_ARE_NAMES else 1)]
    return min(width, len(own)), xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63), using


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))


def item_runs(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, width) and the runs of slots of each item that hold windows of slots alone; of items with the same words, those of the one with the smallest id."""

    def rows(batches):
        canon = Canon()
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("item_id", "words", "width", *_RUN_TYPES)}
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                w, words, using = _item_words(canon, text, width)
                if w < LEAST_WORDS:
                    continue
                for run in slot_runs(canon, text, w):
                    if run[0] in using:
                        for column, x in zip(out.values(), (item, words, w, *run), strict=True):
                            column.append(x)
            yield _arrays(out, {"item_id": pa.int64(), "words": pa.int64(), "width": pa.int32()} | _RUN_TYPES)

    found = arrow_rows(_items(benchmark), rows, f"item_id long, words long, width int, {RUNS}")
    return found.groupBy("words", "width", *_RUN_TYPES).agg(F.min("item_id").alias("item_id")).drop("words")


def item_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, n, width) and the windows of each item; of items with the same words, the one with the smallest id."""

    def rows(batches):
        canon = Canon()
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("item_id", "words", "n", "width", "weak", *_TYPES)}
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                w, words, using = _item_words(canon, text, width)
                if not w:
                    continue
                n = len(canon(text)[0]) - w + 1
                for hashes, template, more, _ in windows(canon, text, [w]):
                    if template and template not in using:
                        continue
                    use, values = more if more else (np.arange(len(hashes)), None)
                    for h, at in zip(hashes.view(np.int64).tolist(), use.tolist(), strict=True):
                        slots = _slots(values, at, w) if template else []
                        weak = template != PLAIN and w - len(slots) < LITERALS
                        found = (item, words, n, w, weak, h, template, at, slots)
                        for column, x in zip(out.values(), found, strict=True):
                            column.append(x)
            yield _arrays(out, {"item_id": pa.int64(), "words": pa.int64(), "n": pa.int32(), "width": pa.int32(), "weak": pa.bool_()} | _TYPES)

    found = arrow_rows(_items(benchmark), rows, f"item_id long, words long, n int, width int, weak boolean, {WINDOWS}")
    return found.groupBy("words", "n", "width", "weak", "h", "template", "at", "slots").agg(F.min("item_id").alias("item_id")).drop("words")


def _bitmap(items: DataFrame) -> np.ndarray:
    """Which low bits of hashes the items have: 2 ** 23 bits, gathered as at most 2 ** 17 numbers."""
    low = F.col("h").bitwiseAND((1 << BITMAP_BITS) - 1)
    words = items.groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS int))")).alias("bits")
    )
    bits = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in words.collect():
        bits[r["word"]] = r["bits"]
    return np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)


def document_windows(docs: DataFrame, items: DataFrame, least_run: int | None = None) -> DataFrame:
    """(doc_id, check) and those windows of each document that an item may have, and for documents with such template windows their runs of
    ``least_run`` slots or more: rows with ``types`` and without ``h``."""
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most WINDOW rows
    bitmap = docs.sparkSession.sparkContext.broadcast(np.packbits(_bitmap(items)))

    def rows(batches):
        canon, known = Canon(), np.unpackbits(bitmap.value).astype(bool)
        low = np.uint64((1 << BITMAP_BITS) - 1)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("doc_id", "check", *_TYPES, "types", "after_word")}
            columns = (batch[c].to_pylist() for c in ("doc_id", "check", "text"))
            for doc_id, check, text in zip(*columns, strict=True):
                templates = False
                for hashes, template, more, width in windows(canon, text, widths):
                    hit = np.flatnonzero(known[hashes & low])
                    if not len(hit):
                        continue
                    if template:
                        use, values = more
                        templates = True
                        found = [(h, int(use[i]), _slots(values, use[i], width)) for i, h in zip(hit, hashes[hit].view(np.int64).tolist(), strict=True)]
                    else:  # once for each document: word for word, its place does not matter
                        found = [(h, 0, []) for h in np.unique(hashes[hit]).view(np.int64).tolist()]
                    for h, at, slots in found:
                        for column, x in zip(out.values(), (doc_id, check, h, template, at, slots, None, None), strict=True):
                            column.append(x)
                for template, at, types, slots, after in slot_runs(canon, text, least_run) if templates and least_run else ():
                    for column, x in zip(out.values(), (doc_id, check, None, template, at, slots, types, after), strict=True):
                        column.append(x)
            yield _arrays(out, {"doc_id": pa.int64(), "check": pa.int64()} | _TYPES | {n: _RUN_TYPES[n] for n in ("types", "after_word")})

    texts = id_and_text(docs).withColumn("check", F.xxhash64("text"))
    return arrow_rows(texts, rows, f"doc_id long, check long, {WINDOWS}, types array<long>, after_word boolean")


def _longest_run(places: Column) -> Column:
    """How many of the places follow one another at most."""

    def step(state: Column, at: Column) -> Column:
        size = F.when(at == state["last"] + 1, state["size"] + 1).otherwise(1)
        return F.struct(at.alias("last"), size.alias("size"), F.greatest(state["best"], size).alias("best"))

    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("size"), F.lit(0).alias("best"))
    return F.aggregate(F.sort_array(places), start, step)["best"]


def _agreeing(item_slots: str, slots: str) -> Column:
    """Values of the item, of the document, and pairs of them are equally many."""
    pairs = F.size(F.array_distinct(F.arrays_zip(item_slots, slots)))
    return (F.size(F.array_distinct(item_slots)) == pairs) & (F.size(F.array_distinct(slots)) == pairs)


def _with_runs(places: DataFrame, runs: DataFrame, document_runs: DataFrame, pair: list[str]) -> DataFrame:
    """Pairs of which an alignment holds the whole item, its runs of slots included.

    ``places`` has all alignments of a pair. Those that lack nothing but the windows of slots alone are compared run by run. An item with templates has a
    word, so a run has a word before it, or else one after it: its start or its end is known in the document, and the join is on that place.
    """
    own = runs.withColumn("size", F.size("slots"))
    own_places = F.sequence(F.col("at"), F.col("at") + F.col("size") - F.col("width"))
    lacking = own.groupBy("item_id", "template").agg(F.flatten(F.collect_list(own_places)).alias("lacking"), F.count("*").alias("runs"))
    one = places.select(*pair, "plain", F.explode("aligned").alias("alignment")).select(*pair, "plain", "alignment.*")
    others = F.array_except(F.array_union("places", "plain"), "lacking")
    near = one.join(lacking, ["item_id", "template"]).where(F.size(others) + F.size("lacking") == F.col("n"))
    expected = near.join(own.select("item_id", "template", "at", "size", "after_word", F.col("types").alias("item_types"), F.col("slots").alias("run_slots")), ["item_id", "template"])
    start = F.col("at") + F.col("shift")
    expected = expected.withColumn("place", F.when(F.col("after_word"), start).otherwise(start + F.col("size"))).drop("at")
    size = F.size("slots")
    ends = F.explode(F.array(F.struct(F.col("at").alias("place"), F.lit(True).alias("from_start")), F.struct((F.col("at") + size).alias("place"), F.lit(False).alias("from_start"))))
    there = document_runs.select(F.col("doc_id").alias("run_doc"), F.col("check").alias("run_check"), F.col("template").alias("run_template"), "types", F.col("slots").alias("values"), ends.alias("end"))
    there = there.select("run_doc", "run_check", "run_template", "types", "values", F.col("end.place").alias("run_place"), "end.from_start")
    same = (
        F.col("doc_id").eqNullSafe(F.col("run_doc")) & (F.col("check") == F.col("run_check")) & (F.col("template") == F.col("run_template"))
        & (F.col("place") == F.col("run_place")) & (F.col("after_word") == F.col("from_start"))
    )
    first = F.when(F.col("after_word"), F.lit(1)).otherwise(F.size("types") - F.col("size") + 1)
    met = expected.join(there, same).where(F.size("types") >= F.col("size"))
    met = met.where(F.slice("types", first, F.col("size")) == F.col("item_types")).withColumn("values", F.slice("values", first, F.col("size")))
    whole = met.groupBy(*pair, "template", "shift", "runs").agg(
        F.count("*").alias("found_runs"),
        F.flatten(F.collect_list("run_slots")).alias("run_slots"), F.flatten(F.collect_list("values")).alias("values"),
        F.any_value("item_slots").alias("item_slots"), F.any_value("slots").alias("slots"),
    ).where("found_runs = runs")
    joined = whole.select(*pair, F.concat("item_slots", "run_slots").alias("item_slots"), F.concat("slots", "values").alias("slots"))
    return joined.where(_agreeing("item_slots", "slots")).select(*pair).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """A row for each document and item found in it: doc_id, check, item_id, found (windows of the item), share."""
    items = stored(item_windows(benchmark), "items")
    runs = stored(item_runs(benchmark), "item_runs")
    least_run = runs.agg(F.min("width")).first()[0]
    known = items.select("h", "template", "item_id", "n", "weak", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    seen = document_windows(docs, items, least_run)
    if least_run:
        seen = stored(seen, "seen_windows")  # documents are read once
    both = seen.where("h IS NOT NULL").drop("types", "after_word").join(known, ["h", "template"])
    both = stored(both, "found_windows")
    pair = ["doc_id", "check", "item_id", "n"]
    aligned = both.where(F.col("template") != PLAIN).groupBy(*pair, "template", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.flatten(F.collect_list("item_slots")).alias("item_slots"),
        F.flatten(F.collect_list("slots")).alias("slots"),
        F.sort_array(F.collect_set("item_at")).alias("places"),
        F.sort_array(F.collect_set(F.when(~F.col("weak"), F.col("item_at")))).alias("strong"),
    )
    # along one alignment
    agreeing = aligned.where(_agreeing("item_slots", "slots"))
    plain = both.where(F.col("template") == PLAIN).select(*pair, "item_at")
    more = ("template", "shift", "item_slots", "slots") if least_run else ()
    places = plain.unionByName(agreeing.select(*pair, F.struct("places", "strong", *more).alias("aligned")), allowMissingColumns=True)
    places = places.groupBy(*pair).agg(F.collect_set("item_at").alias("plain"), F.collect_set("aligned").alias("aligned"))

    def counted(alignment: Column) -> Column:
        whole = F.size(F.array_union(alignment["places"], F.col("plain"))) == F.col("n")
        return F.when(whole, alignment["places"]).otherwise(alignment["strong"])

    every = F.array_union(F.col("plain"), F.flatten(F.transform("aligned", counted)))
    found = places.select(*pair, F.size(every).alias("found"), _longest_run(every).alias("run")).where("found > 0")
    if least_run:
        whole = _with_runs(places, runs, seen.where("h IS NULL"), pair).select(*pair, F.col("n").alias("found"), F.col("n").alias("run"))
        found = found.unionByName(whole).groupBy(*pair).agg(F.max("found").alias("found"), F.max("run").alias("run"))
    found = found.withColumn("share", F.col("found") / F.col("n"))
    return found.where((F.col("share") >= share) | (F.col("run") + WINDOW - 1 >= RUN)).select("doc_id", "check", "item_id", "found", "share")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` without benchmark passages, with all their columns."""
    return without_rows(docs, contaminated(docs.select("doc_id", "text"), benchmark, share))
