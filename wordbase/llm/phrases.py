"""Phrase collocations from a suffix tree of words, built in independent groups of prefixes.

The tree is partitioned vertically, as in elastic-range construction: prefixes are counted, one that occurs in more places than a
group may hold is replaced by its extensions by a word, and so on; then prefixes are dealt to groups until a group
holds its share. The suffixes that begin with a group's prefixes, cut off at the depth that phrases need, make its subtree, which is built
without looking at other groups. How often a phrase occurs is the sum of the leaf totals below its node.

How it runs: tasks cut texts into blocks and number the block's words, so that suffixes are columns of numbers. Words are counted
first. One that occurs less than ``least`` times is in no phrase that does, so suffixes neither begin with it nor go on to it; a bitmap, of a size
by the number of words that are left and 8 MB at most, tells tasks which these are, and those it lets through in vain only cost their place. Equal
suffixes of a block are one leaf with its total. A block sends to each group one row with its leaves, compressed, and the words these use. Prefixes are dealt
in the order of their hashes: what all tasks must know is where a group's range of hashes begins, and the prefixes that were
extended. There are at most (words of the corpus / ``group_words``) of either, times the depth for the second; a group has at most
twice ``group_words`` suffixes, and fewer leaves. A phrase of full depth that is more frequent than that is one leaf for each block.
All that follows works on the nodes that occur ``least`` times. Ranks come from one global sort, counted by sorted partition, so a language of any size is
no hot spot.

Texts are UTF-8 in lower case (A-Z only), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words at spaces and tabs. Scores are
whole numbers, from decimals of 38 digits: exact up to 10 ** 16 occurrences of a phrase.

Defined results: a null text is an empty one, a null language ``und``, the same as that name. Repeated rows all count. Texts without words and an empty
table give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordbase.llm.common import arrow_rows, few_rows, raw_texts, shuffle_partitions
from wordbase.operators.keyed import spread_join
from wordbase.runtime import stored

WORDS = 3
LEAST = 10
TOP = 2000
GROUP_WORDS = 1_000_000
BLOCK_WORDS = 1_000_000
BITMAP_BITS = 26  #: at most, as a power of two
SLICE = 1 << 20

BREAK = b"\xff"  #: no byte of UTF-8
_ZERO = np.zeros(1, np.int32)
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10 + b" ")

Hot = list[dict[bytes, int]]  #: for each depth the extended prefixes, by name, with their counts


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists, with ``BREAK`` between pieces."""
    data = text.translate(_TABLE).replace(BREAK, b" \xff ")
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + SLICE)
        stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


def named(words: bytes, lang: bytes) -> bytes:
    """A phrase with its language; no word holds a line break."""
    return words + b"\n" + lang


def hashed(name: bytes) -> int:
    h = xxhash.xxh64_intdigest(name)
    return h - (1 << 64) if h >> 63 else h


def packed(columns: list[np.ndarray], below: int) -> np.ndarray:
    """One number for each row of columns of numbers, in the order of the rows."""
    key = columns[0].astype(np.int64)
    most = below
    for column in columns[1:]:
        if most * below >= 1 << 62:
            values, key = np.unique(key, return_inverse=True)
            most = len(values)
        key, most = key * below + column, most * below
    return key


class Numbers(dict):
    """Numbers of the words of one language from 1, given as they come; ``names`` lists the words of all languages."""

    def __init__(self, lang: bytes, names: list[tuple[bytes, bytes]]):
        self.lang, self.names = lang, names
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self.names.append((word, self.lang))
        self[word] = number = len(self.names)
        return number


class Block:
    """The words of some texts as numbers from 1, with 0 at the end of a piece."""

    def __init__(self, depth: int):
        self.depth = depth
        self.clear()

    def clear(self) -> None:
        self.names_of: list[tuple[bytes, bytes]] = []
        self.numbers: dict[bytes, Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: bytes, words: list[bytes]) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = Numbers(lang, self.names_of)
        self.parts.append(np.fromiter(map(self.numbers[lang].__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def end(self) -> None:
        """The end of a text."""
        self.parts.append(_ZERO)

    def hashes(self) -> np.ndarray:
        digest, names = xxhash.xxh64_intdigest, self.names_of
        made = np.zeros(len(names) + 1, np.uint64)
        made[1:] = np.fromiter((digest(b"%b\n%b" % name) for name in names), np.uint64, len(names))
        return made.view(np.int64)

    def suffixes(self, last: bool, frequent: np.ndarray | None) -> list[np.ndarray]:
        """Columns of the suffixes, cut off at the depth and filled with 0; those that may go on in the next block are left to it.

        With a bitmap of ``frequent`` words the others count as ends of pieces."""
        row = np.concatenate(self.parts) if self.parts else _ZERO[:0]
        self.tail = [] if last or self.depth == 1 else [self.names_of[i - 1] if i else None for i in row[len(row) - self.depth + 1 :].tolist()]
        self.known = self.hashes()
        if frequent is not None:
            keep = among(self.known, frequent)
            keep[0] = False
            row = np.where(keep[row], row, 0)
        n = len(row) - len(self.tail)
        row = np.concatenate([row, np.zeros(self.depth, row.dtype)])
        columns = [row[:n]]
        for k in range(1, self.depth):
            columns.append(np.where(columns[-1] > 0, row[k : n + k], 0))
        there = columns[0] > 0
        return [c[there] for c in columns]

    def next(self) -> None:
        tail = self.tail
        self.clear()
        for name in tail:
            if name is None:
                self.end()
            else:
                self.add(name[1], [name[0]])

    def names(self, rows: np.ndarray) -> list[bytes]:
        """The phrases of rows of numbers, with their languages."""
        names = self.names_of
        return [named(b" ".join([names[i - 1][0] for i in row]), names[row[0] - 1][1]) for row in rows.tolist()]

    def rows(self, names: Iterable[bytes], size: int) -> np.ndarray:
        """The rows of numbers of those phrases of ``size`` words, named with their languages, whose words the block all has."""
        found = []
        for name in names:
            phrase, lang = name.split(b"\n", 1)
            numbers = self.numbers.get(lang, {})
            row = [numbers.get(word, 0) for word in phrase.split(b" ")]
            if all(row):
                found.append(row)
        return np.array(found, np.int64).reshape(len(found), size)

    @property
    def below(self) -> int:
        """All numbers are below this one."""
        return len(self.names_of) + 1


def among(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    place = hashes & (64 * len(bitmap) - 1)
    return (bitmap[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def blocks(batches: Iterator[pa.RecordBatch], depth: int, frequent: np.ndarray | None) -> Iterator[tuple[Block, list[np.ndarray]]]:
    block = Block(depth)
    most = BLOCK_WORDS * WORDS // depth  # fewer columns, more words
    for batch in few_rows(batches):
        for lang, text in zip(raw_texts(batch["lang"]), raw_texts(batch["text"]), strict=True):
            for words in tokens(text):
                block.add(lang, words)
                if block.size >= most:
                    yield block, block.suffixes(False, frequent)
                    block.next()
            block.end()
    yield block, block.suffixes(True, frequent)


def counted(columns: list[np.ndarray], below: int) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of the columns, in order, and how often each occurs."""
    if below ** len(columns) >= 1 << 62:
        _, at, times = np.unique(packed(columns, below), return_index=True, return_counts=True)
        return np.column_stack([c[at] for c in columns]), times
    # a number gives its row back, so plain numbers are sorted, not places
    keys, times = np.unique(packed(columns, below), return_counts=True)
    rows = np.empty((len(keys), len(columns)), columns[0].dtype)
    for k in range(len(columns) - 1, 0, -1):
        left = keys // below
        rows[:, k] = keys - left * below
        keys = left
    rows[:, 0] = keys
    return rows, times


def extended(block: Block, leaves: np.ndarray, hot: Hot) -> np.ndarray:
    """How many words the prefix has that decides on the group of each leaf; 0 where a leaf ends within extended prefixes."""
    level = np.ones(len(leaves), np.int8)
    for depth, own in enumerate(hot, 1):
        at = np.flatnonzero(level == depth)
        if not own or not len(at):
            break
        here = block.rows(own, depth)
        if depth == 1:
            deeper = np.zeros(block.below, bool)
            deeper[here] = True
            at = at[deeper[leaves[at, 0]]]
        else:
            both = np.concatenate([here, leaves[at, :depth]])
            keys = packed([both[:, k] for k in range(depth)], block.below)
            at = at[np.isin(keys[len(here) :], keys[: len(here)])]
        level[at] = np.where(leaves[at, depth] > 0, depth + 1, 0)
    return level


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    )


def prefix_counts(texts: DataFrame, depth: int, hot: Hot, frequent: np.ndarray | None) -> DataFrame:
    """(name, h, n) of the phrases of this many words whose phrase without the last word is extended; of all words at depth 1."""
    shared = texts.sparkSession.sparkContext.broadcast((hot, frequent))

    def rows(batches):
        hot, frequent = shared.value
        for block, columns in blocks(batches, depth, frequent):
            if depth == 1:
                n = np.bincount(columns[0], minlength=block.below)[1:]
                names, h = [named(*name) for name in block.names_of], block.known[1:]
            else:
                found, n = counted(columns, block.below)
                keep = (extended(block, found, hot) == depth) & (found[:, -1] > 0)
                names, n = block.names(found[keep]), n[keep]
                h = np.array([hashed(x) for x in names], np.int64)
            for i in range(0, len(names), 50_000):
                some = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(names[some], pa.binary()), pa.array(h[some]), pa.array(n[some])], names=["name", "h", "n"])

    return arrow_rows(texts, rows, "name binary, h long, n long").groupBy("name", "h").agg(F.sum("n").alias("n"))


def bitmap(words: DataFrame) -> np.ndarray:
    """Bits by the hashes of words, some 16 for each as far as ``BITMAP_BITS`` allow."""
    bits = 1 << min(max(16, (16 * words.count() - 1).bit_length()), BITMAP_BITS)
    place = F.col("h").bitwiseAND(bits - 1)
    sums = words.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("at"))
    found = sums.agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS int))")).alias("bits")).toArrow()  # one row for 64 bits at most
    made = np.zeros(bits // 64, np.int64)
    made[found["at"].to_numpy()] = found["bits"].to_numpy()
    return made.view(np.uint64)


class Plan(NamedTuple):
    """What tasks know of the whole: the extended prefixes, the hashes at which groups begin, and the bitmap of words to go on with."""

    hot: Hot
    starts: np.ndarray
    frequent: np.ndarray


def vertical(texts: DataFrame, depth: int, least: int, group_words: int) -> tuple[DataFrame, Plan]:
    """All words with their counts, and how the prefixes are dealt to groups."""
    words = stored(prefix_counts(texts, 1, [], None), "prefixes")
    prefixes = words.where(F.col("n") >= least)
    frequent = bitmap(prefixes)
    hot: Hot = []
    dealt = prefixes.where(F.col("n") <= group_words) if depth > 1 else prefixes
    for d in range(1, depth):
        own = {bytes(r["name"]): r["n"] for r in prefixes.where(F.col("n") > group_words).select("name", "n").collect()}
        if not own:
            break
        hot.append(own)
        prefixes = stored(prefix_counts(texts, d + 1, hot, frequent), "prefixes")
        dealt = dealt.union(prefixes.where(F.col("n") <= group_words) if d + 1 < depth else prefixes)
    ranges = max(4, (shuffle_partitions(texts.sparkSession) - 1).bit_length())
    order = Window.partitionBy("range").orderBy("h")
    before = F.coalesce(F.sum(F.least("n", F.lit(group_words))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    filled = dealt.select("h", "n", F.shiftright("h", 64 - ranges).alias("range")).select("h", "range", F.floor(before / group_words).alias("filled"))
    first = filled.withColumn("last", F.lag("filled").over(order)).where("last IS NULL OR last < filled")
    starts = sorted(r["h"] for r in first.select("h").collect())
    return words, Plan(hot, np.array(starts, np.int64), frequent)


LEAVES = "group int, leaves binary"


def leaf_rows(texts: DataFrame, depth: int, plan: Plan) -> DataFrame:
    """For each block and group a row with its leaves and the words these use (see ``packed_leaves``)."""
    shared = texts.sparkSession.sparkContext.broadcast(plan)

    def rows(batches):
        hot, starts, frequent = shared.value
        for block, columns in blocks(batches, depth, frequent):
            below = block.below
            leaves, totals = counted(columns, below)
            levels = extended(block, leaves, hot)
            group = np.full(len(leaves), -1, np.int32)
            at = np.flatnonzero(levels == 1)
            group[at] = np.searchsorted(starts, block.known[leaves[at, 0]], "right")
            for level in range(2, depth + 1):
                at = np.flatnonzero(levels == level)
                prefix, some, inverse = np.unique(packed([leaves[at, k] for k in range(level)], below), return_index=True, return_inverse=True)
                h = np.array([hashed(x) for x in block.names(leaves[at[some], :level])], np.int64)
                group[at] = np.searchsorted(starts, h, "right")[inverse]
            order = np.argsort(group, kind="stable")
            order = order[np.searchsorted(group[order], 0) :]  # leaves without a group end within extended prefixes, whose counts are known
            yield from _leaf_batches(block, group[order], leaves[order], levels[order], totals[order])

    return arrow_rows(texts, rows, LEAVES)


def _leaf_batches(block: Block, group: np.ndarray, leaves: np.ndarray, levels: np.ndarray, totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    groups, first = np.unique(group, return_index=True)
    ends = np.append(first, len(group)).tolist()
    number_of = {lang: i for i, lang in enumerate(block.numbers)}
    lang_at = np.fromiter((number_of[lang] for _, lang in block.names_of), np.int64, len(block.names_of))
    made: list[tuple] = []
    size = 0
    for number, a, b in zip(groups.tolist(), ends, ends[1:], strict=False):
        used, index = np.unique(leaves[a:b], return_inverse=True)
        index = index.reshape(b - a, -1) + (used[0] > 0)  # 0 stays 0
        data = packed_leaves(block, used[used > 0], lang_at, index, levels[a:b], totals[a:b])
        made.append((number, data))
        size += len(data)
        if size > 4_000_000:
            yield _leaf_batch(made)
            made, size = [], 0
    if made:
        yield _leaf_batch(made)


def _leaf_batch(made: list[tuple]) -> pa.RecordBatch:
    groups, data = zip(*made, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), pa.array(data, pa.binary())], names=["group", "leaves"])


_HEAD = struct.Struct("<IIHBBI")  #: leaves, bytes of the words, languages, width of numbers, width of totals, bytes of all that follows


def packed_leaves(block: Block, used: np.ndarray, lang_at: np.ndarray, index: np.ndarray, levels: np.ndarray, totals: np.ndarray) -> bytes:
    """Words (in order of language) and leaves: levels, numbers of the words (from 1) by depth, and totals, in few bytes each and compressed if that pays."""
    names = block.names_of
    order = np.argsort(lang_at[used - 1], kind="stable")
    own, counts = np.unique(lang_at[used - 1], return_counts=True)
    if len(own) > 1:
        number = np.zeros(len(used) + 1, np.int64)
        number[order + 1] = np.arange(1, len(used) + 1)
        index = number[index]
    words = b"\n".join([names[i][0] for i in (used[order] - 1).tolist()])  # no word holds a line break
    by_lang = list(zip([list(block.numbers)[i] for i in own.tolist()], counts.tolist(), strict=True))
    langs = b"".join(struct.pack("<II", len(lang), n) + lang for lang, n in by_lang)
    numbers = np.ascontiguousarray(index.T.astype(np.min_scalar_type(len(used))))
    times = totals.astype(np.min_scalar_type(totals.max()))
    body = langs + words + levels.tobytes() + numbers.tobytes() + times.tobytes()
    head = _HEAD.pack(len(levels), len(words), len(by_lang), numbers.itemsize, times.itemsize, len(body))
    small = pa.compress(body, "zstd", asbytes=True) if len(body) > 100 else body
    return head + min(body, small, key=len)  # of equal length it is the plain one


def unpacked(rows: pa.Table, depth: int) -> tuple[list[tuple[bytes, bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows with their languages, and the leaves with numbers of these (from 1), levels and totals."""
    numbers: dict[bytes, dict[bytes, int]] = {}
    names: list[tuple[bytes, bytes]] = []
    leaves, levels, totals = [], [], []
    for data in rows["leaves"].to_pylist():
        n, n_words, n_langs, width, total_width, size = _HEAD.unpack_from(data)
        data = data[_HEAD.size :] if len(data) == size + _HEAD.size else pa.decompress(data[_HEAD.size :], size, "zstd", asbytes=True)
        at, own = 0, []
        for _ in range(n_langs):
            length, count = struct.unpack_from("<II", data, at)
            own.append((data[at + 8 : at + 8 + length], count))
            at += 8 + length
        words = data[at : at + n_words].split(b"\n")
        at += n_words
        code, done = [0], 0
        for lang, count in own:
            known = numbers.get(lang)
            if known is None:
                known = numbers[lang] = Numbers(lang, names)
            code += map(known.__getitem__, words[done : done + count])
            done += count
        levels.append(np.frombuffer(data, np.int8, n, at))
        leaves.append(np.array(code, np.int32)[np.frombuffer(data, f"u{width}", n * depth, at + n)].reshape(depth, n))
        totals.append(np.frombuffer(data, f"u{total_width}", n, at + n * (1 + depth * width)).astype(np.int64))
    return names, np.concatenate(leaves, axis=1), np.concatenate(levels), np.concatenate(totals)


NODES = "lang string, phrase string, size int, f long, parts array<long>"


def subtree(rows: pa.Table, depth: int, least: int, hot: Hot) -> pa.Table:
    """The nodes of one group that occur often enough: their counts, and those of the nodes above them, from the leaf totals."""
    names, leaves, levels, totals = unpacked(rows, depth)
    order = np.argsort(packed(list(leaves), len(names) + 1))
    leaves, levels, totals = leaves[:, order], levels[order], totals[order]
    words = pa.array([x[0] for x in names], pa.binary()).cast(pa.string())
    langs = pa.array([x[1] for x in names], pa.binary()).cast(pa.string())

    above: list[np.ndarray] = []  # by depth: the count of each leaf's prefix
    tables = []
    new = np.zeros(len(totals), bool)
    new[:1] = True
    for d in range(1, depth + 1):
        new[1:] |= leaves[d - 1, 1:] != leaves[d - 1, :-1]
        starts = np.flatnonzero(new)
        f = np.add.reduceat(totals, starts)
        above.append(np.repeat(f, np.diff(np.append(starts, len(totals)))))
        keep = (f >= least) & (leaves[d - 1, starts] > 0) & (levels[starts] <= d)
        at = starts[keep]
        own = leaves[:d, at] - 1
        parts = np.column_stack([above[k][at] for k in range(d - 1)]) if d > 1 else np.zeros((len(at), 0), np.int64)
        for i in np.flatnonzero(levels[at] > 1).tolist():  # the first words are an extended prefix, counted before
            for k in range(1, levels[at[i]]):
                parts[i, k - 1] = hot[k - 1][named(b" ".join(names[w][0] for w in own[:k, i]), names[own[0, i]][1])]
        taken = [words.take(pa.array(w)) for w in own]
        phrase = pc.binary_join_element_wise(*taken, " ") if d > 1 else taken[0]
        offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * (d - 1), pa.int32())
        tables.append(pa.table(
            [langs.take(pa.array(own[0])), phrase, pa.array(np.full(len(at), d, np.int32)), pa.array(f[keep]), pa.ListArray.from_arrays(offsets, pa.array(parts.ravel()))],
            names=["lang", "phrase", "size", "f", "parts"],
        ))
    return pa.concat_tables(tables)


def nodes(docs: DataFrame, words: int = WORDS, least: int = LEAST, group_words: int = GROUP_WORDS) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``words`` words that occur ``least`` times: lang, phrase, size, f, and parts: the counts of its first 1, 2, ... words;
    and the number of words of each language (lang, n)."""
    spark = docs.sparkSession
    texts = _texts(docs)
    counts, plan = vertical(texts, words, least, group_words)
    hot, shared = plan.hot, spark.sparkContext.broadcast(plan.hot)
    leaves = leaf_rows(texts, words, plan)
    below = leaves.groupBy("group").applyInArrow(lambda rows: subtree(rows, words, least, shared.value), NODES)
    extended_nodes = [
        (lang.decode(), phrase.decode(), d, n, [hot[k - 1][named(b" ".join(phrase.split(b" ")[:k]), lang)] for k in range(1, d)])
        for d, own in enumerate(hot, 1)
        for (phrase, lang), n in ((name.split(b"\n", 1), n) for name, n in own.items())
        if n >= least
    ]
    all_nodes = below.union(spark.createDataFrame(extended_nodes, NODES)) if extended_nodes else below
    name = F.col("name").cast("string")
    lang = F.substring(name, F.instr(name, "\n") + 1, F.length(name))
    totals = counts.select(lang.alias("lang"), "n").groupBy("lang").agg(F.sum("n").alias("n"))
    return stored(all_nodes, "nodes"), stored(totals, "totals")


def scored(nodes: DataFrame) -> DataFrame:
    """Phrases of two words or more with the counts of their parts at the lowest-scoring cut, the first of equal ones: lang, phrase, size, a, l, r, score."""
    split = F.split("phrase", " ")
    cuts = nodes.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), split.alias("words"), F.posexplode("parts").alias("k", "l"))
    cuts = cuts.withColumn("rest", F.array_join(F.expr("slice(words, k + 2, size)"), " ")).drop("words")
    rights = nodes.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = spread_join(stored(cuts, "cuts"), rights, ["lang", "rest"])
    wide = {x: F.col(x).cast("decimal(19,0)") for x in "alr"}
    score = F.expr("(CAST(1000000 AS decimal(7,0)) * (wide_a * wide_a)) div (wide_l * wide_r)")
    worth = both.withColumns({f"wide_{x}": c for x, c in wide.items()}).withColumn("score", score)
    picked = worth.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return picked.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def without_parts(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """``phrases`` (lang, phrase, size, a) without those inside a longer one that occurs ``percent`` in a hundred as often or more."""
    words = F.split("phrase", " ")
    long = phrases.where("size > 2").select("lang", "size", words.alias("words"), F.col("a").alias("longer"))
    inside = F.flatten(
        F.transform(F.expr("sequence(2, size - 1)"), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " ")))
    )
    most = long.select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = phrases.join(most, ["lang", "phrase"], "left")
    return joined.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent)).drop("longer")


def ranked(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first rows of each language with their ``rank``.

    One global sort; the rank in a language is the place in a sorted partition and the sizes of the language's partitions before it."""
    order = phrases.orderBy("lang", F.desc("score"), F.desc("a"), "phrase").withColumn("at", F.monotonically_increasing_id())
    placed = stored(order, "sorted").withColumn("partition", F.shiftright("at", 33))
    sizes = placed.groupBy("lang", "partition").agg(F.min("at").alias("low"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("lang").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("lang", "partition", "low", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")).alias("before"))
    # partitions that begin beyond the last rank need not be looked at
    joined = placed.join(stored(before.where(F.col("before") < top), "partitions"), ["lang", "partition"])
    return joined.withColumn("rank", F.col("at") - F.col("low") + F.col("before") + 1).where(F.col("rank") <= top)


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, top: int = TOP, group_words: int = GROUP_WORDS) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    found, totals = nodes(docs, words, least, group_words)
    best = ranked(without_parts(stored(scored(found), "scored")), top)
    return spread_join(best.select("lang", "rank", "phrase", "a", "l", "r", "score"), totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
