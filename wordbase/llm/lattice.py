"""Language-model scores: the probability of a text over all its segmentations into subwords.

The pieces are those of an existing subword vocabulary, and its scores are where learning starts: piece ``r`` in the order of
scores has a probability in proportion to 1 / (1 + r). Expectation-maximisation over all words of the training
documents, each distinct word once and weighted by its count, makes them fit the corpus. A word's probability is
the sum over all its segmentations, by a forward recursion in log space; words start with the space mark and no piece spans two
words, so a text's probability is the product over its words and the end. Pieces and the end share
one distribution; single bytes are pieces, so every text has a probability.

How it runs: tasks cut documents into blocks, and turn each document into numbers of the block's own
words. What is shuffled is one row for each block and distinct word, to count and to bring back what the
word is worth, and the documents' numbers. A frequent word is a row for each block, not for each time it
occurs. Each distinct word runs through the lattice once, whole arrays of words of equal length at a time; a very long one in stretches, of which
the recursion needs the last places only.

Defined results: a null or empty text is the end alone. A null id counts as a training document. Rows
with equal ids get a row each. An empty table gives no rows; without training documents the vocabulary's own
scores remain and every token is unknown. Other columns are not looked at.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.llm.common import arrow_rows, few_rows, id_and_text, raw_texts
from wordbase.runtime import stored

END = b""  #: the token after the last word; no word is empty
BLOCK_BYTES = 16_000_000
ROUNDS = 3
PRIOR = 1.0  #: weight of the starting distribution, in counts for each piece
WORDS_AT_ONCE = 20_000
LONG_WORD = 1000  #: bytes; longer words go through the lattice one by one, many places at once
STRETCH = 50_000  #: places whose matches are held at a time
_SCALED = math.log(1e100)


class Pieces:
    """A trie of pieces as one table of transitions; state 0 is dead, 1 the root."""

    def __init__(self, pieces: list[bytes]):
        edges: list[dict[int, int]] = [{}, {}]
        self.piece_at = [-1, -1]
        for number, piece in enumerate(pieces):
            state = 1
            for byte in piece:
                if byte not in edges[state]:
                    edges[state][byte] = len(edges)
                    edges.append({})
                    self.piece_at.append(-1)
                state = edges[state][byte]
            self.piece_at[state] = number
        self.next = np.zeros((len(edges), 256), np.int32)
        for state, out in enumerate(edges):
            for byte, to in out.items():
                self.next[state, byte] = to
        self.piece_at = np.array(self.piece_at)
        self.longest = max(map(len, pieces))

    def matches(self, words: np.ndarray):
        """Of words of one length, a row of bytes each: (from, to, rows, pieces), by place of the start."""
        rows, length = words.shape
        for start in range(length):
            at = np.arange(rows)
            state = np.ones(rows, np.int32)
            for stop in range(start + 1, min(start + self.longest, length) + 1):
                state = self.next[state, words[at, stop - 1]]
                alive = state > 0
                at, state = at[alive], state[alive]
                if not len(at):
                    break
                piece = self.piece_at[state]
                full = piece >= 0
                if full.any():
                    yield start, stop, at[full], piece[full]

    def matches_within(self, word: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, pieces) of one word, for all places from ``a`` to before ``b`` at once."""
        start = np.arange(max(a, 0), min(b, len(word)))
        state = np.ones(len(start), np.int32)
        found = []
        for size in range(1, self.longest + 1):
            inside = start + size <= len(word)
            start, state = start[inside], state[inside]
            state = self.next[state, word[start + size - 1]]
            alive = state > 0
            start, state = start[alive], state[alive]
            piece = self.piece_at[state]
            full = piece >= 0
            found.append((start[full], start[full] + size, piece[full]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def along(self, word: np.ndarray, scores: np.ndarray, back: bool) -> np.ndarray:
        """Log sums over all ways to each place of one word from its start, or, by distance from the end, from its end.

        The recursion looks back ``longest`` places only. It runs on plain numbers, which are scaled up when they get small.
        """
        n, reach = len(word), self.longest
        made = np.full(n + 1, -np.inf)
        made[0], window, scaled = 0.0, [1.0], 0
        for a in range(0, n, STRETCH):
            b = min(a + STRETCH, n)
            if back:
                start, stop, piece = self.matches_within(word, n - b, n - a)
                start, stop = n - stop, n - start
            else:
                start, stop, piece = self.matches_within(word, a - reach + 1, b)
                new = stop > a
                start, stop, piece = start[new], stop[new], piece[new]
            inside = stop <= b
            start, stop, piece = start[inside], stop[inside], piece[inside]
            order = np.argsort(stop, kind="stable")
            window = window[-reach:]
            first = a + 1 - len(window)  # the place of the window's first number
            origin, chance = (start[order] - first).tolist(), np.exp(scores[piece[order]]).tolist()
            ends = np.searchsorted(stop[order], np.arange(a + 1, b + 2)).tolist()
            for j in range(b - a):
                total = 0.0
                for i in range(ends[j], ends[j + 1]):
                    total += window[origin[i]] * chance[i]
                window.append(total)
                if total > 0:
                    made[a + j + 1] = math.log(total) - scaled * _SCALED
                    if total < 1e-100:
                        window[-reach:] = [x * 1e100 for x in window[-reach:]]
                        scaled += 1  # counted, as a sum of logarithms would gather rounding
        return made

    def expected_along(self, word: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces in one word."""
        reached, left = self.along(word, scores, False), self.along(word, scores, True)
        total = np.zeros(len(scores))
        for a in range(0, len(word), STRETCH):
            start, stop, piece = self.matches_within(word, a, a + STRETCH)
            share = np.exp(reached[start] + scores[piece] + left[len(word) - stop] - reached[-1])
            total += np.bincount(piece, share, len(scores))
        return total

    def forward(self, words: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Log probabilities of words of one length."""
        if words.shape[1] > LONG_WORD:
            return np.array([self.along(word, scores, False)[-1] for word in words])
        reached = np.full((words.shape[1] + 1, len(words)), -np.inf)
        reached[0] = 0
        for start, stop, at, piece in self.matches(words):
            reached[stop, at] = np.logaddexp(reached[stop, at], reached[start, at] + scores[piece])
        return reached[-1]

    def expected(self, words: np.ndarray, counts: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces in words of one length, given how often each word occurs."""
        if words.shape[1] > LONG_WORD:
            return sum((n * self.expected_along(word, scores) for word, n in zip(words, counts, strict=True)), np.zeros(len(scores)))
        found = list(self.matches(words))
        reached = np.full((words.shape[1] + 1, len(words)), -np.inf)
        reached[0] = 0
        for start, stop, at, piece in found:
            reached[stop, at] = np.logaddexp(reached[stop, at], reached[start, at] + scores[piece])
        left = np.full_like(reached, -np.inf)
        left[-1] = 0
        total = np.zeros(len(scores))
        for start, stop, at, piece in reversed(found):
            ahead = scores[piece] + left[stop, at]
            left[start, at] = np.logaddexp(left[start, at], ahead)
            share = np.exp(reached[start, at] + ahead - reached[-1, at]) * counts[at]
            total += np.bincount(piece, share, len(scores))
        return total


def by_length(words: list[bytes]):
    """(positions, rows of bytes) of words with the space mark before them, grouped by length and in bounded numbers."""
    length = np.array([len(w) for w in words])
    for n in np.unique(length):
        where = np.flatnonzero(length == n)
        step = max(1, min(WORDS_AT_ONCE, 2_000_000 // (int(n) + 1)))
        for i in range(0, len(where), step):
            some = where[i : i + step]
            rows = np.frombuffer(b"".join(b" " + words[k] for k in some), np.uint8).reshape(len(some), n + 1)
            yield some, rows


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces, as bytes with a space for the mark, and starting log probabilities; the last place is the end's.

    Pieces of bytes stand for that byte, unless a piece of one byte is there already. Control pieces and pieces
    with a space beside their start are left out: no word holds them.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i):
            continue
        piece = bytes([int(name[3:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        if piece and b" " not in piece[1:]:
            scores[piece] = max(scores.get(piece, -np.inf), model.get_score(i) if not model.is_byte(i) else -1e9)
    pieces = sorted(scores, key=lambda p: (-scores[p], p))
    weight = 1 / (1.0 + np.arange(len(pieces) + 1))
    return pieces, np.log(weight / weight.sum())


def _bags(docs: DataFrame, held_out: Column) -> DataFrame:
    """Blocks of documents: a row for each distinct word of a block and a row for each document.

    A block's number is drawn at random; the table is written once, so its words and documents agree.
    """

    def rows(batches):
        words: dict[bytes, int] = {END: 0}
        training: list[int] = [0]
        held: list[tuple] = []
        size = 0

        for batch in few_rows(batches):
            for doc_id, out, text in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), raw_texts(batch["text"]), strict=True):
                count = Counter(text.lower().split())
                count[END] = 1
                ids = np.fromiter((words.setdefault(w, len(words)) for w in count), np.uint32, len(count))
                times = np.fromiter(count.values(), np.uint32, len(count))
                training += [0] * (len(words) - len(training))
                if not out:
                    for i, n in zip(ids.tolist(), times.tolist(), strict=True):
                        training[i] += n
                held.append((doc_id, out, int(times.sum()), *packed(ids, times)))
                size += len(text) + 100
                if size >= BLOCK_BYTES:
                    yield from _block_batches(words, training, held)
                    words, training, held, size = {END: 0}, [0], [], 0
        if held:
            yield from _block_batches(words, training, held)

    texts = id_and_text(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return arrow_rows(texts, rows, BAG)


def packed(ids: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers of words in order, as differences, and how often each occurs in as few bytes as that takes."""
    order = np.argsort(ids)
    ids, times = ids[order], times[order]
    return np.diff(ids, prepend=np.uint32(0)).tobytes(), times.astype(np.min_scalar_type(times.max())).tobytes()


def unpacked(ids: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.cumsum(np.frombuffer(ids, np.uint32))
    return numbers, np.frombuffer(times, f"u{len(times) // len(numbers)}")


BAG = (
    "block long, word binary, number int, n_train long,"
    " doc_id long, held_out boolean, n_tokens long, ids binary, times binary"
)
_BAG_ARROW = pa.schema(
    [("block", pa.int64()), ("word", pa.binary()), ("number", pa.int32()), ("n_train", pa.int64()),
     ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("times", pa.binary())]
)


def _block_batches(words: dict[bytes, int], training: list[int], held: list[tuple]):
    block = int.from_bytes(os.urandom(8), "little", signed=True)
    for made in (
        {"block": [block] * len(words), "word": list(words), "number": list(range(len(words))), "n_train": training},
        dict(zip(["block", "doc_id", "held_out", "n_tokens", "ids", "times"], zip(*((block, *d) for d in held), strict=True), strict=True)),
    ):
        n = len(made["block"])
        columns = [pa.array(made[f.name], f.type) if f.name in made else pa.nulls(n, f.type) for f in _BAG_ARROW]
        table = pa.RecordBatch.from_arrays(columns, schema=_BAG_ARROW)
        for i in range(0, n, 20_000):
            yield table.slice(i, 20_000)


def _fitted(words: DataFrame, pieces: list[bytes], start: np.ndarray, rounds: int) -> np.ndarray:
    """Log probabilities of the pieces and the end, by expectation-maximisation over the training words."""
    spark = words.sparkSession
    context = spark.sparkContext
    vocabulary = context.broadcast(tuple(pieces))
    ends = words.where(F.octet_length("word") == 0).agg(F.sum("c")).first()[0] or 0
    scores = start
    for _ in range(rounds):
        shared = context.broadcast(scores)

        def rows(batches, shared=shared):
            lattice, scores = trie(vocabulary.value), shared.value
            total = np.zeros(len(scores))
            for table in larger(batches):
                counts = table["c"].to_numpy()
                for at, matrix in by_length(table["word"].to_pylist()):
                    total += lattice.expected(matrix, counts[at], scores)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "n"])

        train = words.where("c > 0 AND octet_length(word) > 0")
        expected = arrow_rows(train.select("word", "c"), rows, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = PRIOR * len(pieces) * np.exp(start)
        for r in expected.collect():  # at most one row for each piece of the vocabulary
            counts[r["piece"]] += r["n"]
        counts[-1] = ends + PRIOR
        scores = np.log(counts / counts.sum())
    return scores


@lru_cache(maxsize=2)
def trie(pieces: tuple[bytes, ...]) -> Pieces:
    """Built once for each worker process."""
    return Pieces(list(pieces))


def larger(batches, rows: int = 100_000):
    """Tables of at least so many rows, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _word_scores(words: DataFrame, pieces: list[bytes], scores: np.ndarray) -> DataFrame:
    """``words`` (word, c) with log10 probabilities, each over all segmentations; that of the end with it."""
    context = words.sparkSession.sparkContext
    vocabulary, shared = context.broadcast(tuple(pieces)), context.broadcast(scores)

    def rows(batches):
        lattice, scores = trie(vocabulary.value), shared.value
        for table in larger(batches):
            own = table["word"].to_pylist()
            found = np.empty(len(own))
            for at, matrix in by_length(own):
                found[at] = lattice.forward(matrix, scores)
            found[[i for i, w in enumerate(own) if w == END]] = scores[-1]
            made = pa.table([table["word"], table["c"], pa.array(found / np.log(10))], names=["word", "c", "score"])
            yield from made.to_batches(max_chunksize=20_000)

    return arrow_rows(words.select("word", "c"), rows, "word binary, c long, score double")


def document_scores(docs: DataFrame, held_out: Column, vocabulary_path: str, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``held_out`` is not true. ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1)))
    over the tokens, by counts of whole words; ``score`` the log10 probability of the text by the lattice.
    """
    bags = stored(_bags(docs, held_out), "bags")
    local = bags.where("word IS NOT NULL").select("block", "number", "word", "n_train")
    words = stored(local.groupBy("word").agg(F.sum("n_train").alias("c")), "words")
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    pieces, start = read_vocabulary(vocabulary_path)
    scored = _word_scores(words, pieces, _fitted(words, pieces, start, rounds))
    worth = local.select(F.col("block").alias("word_block"), "number", "word").join(scored, "word").drop("word")
    held = bags.where("ids IS NOT NULL").select("block", "doc_id", "held_out", "n_tokens", "ids", "times")

    def rows(held: pa.Table, worth: pa.Table) -> pa.Table:
        number = worth["number"].to_numpy()
        c = worth["c"].to_numpy()
        values = np.zeros((len(number), 3))
        values[number] = np.column_stack([c > 0, np.log10((c + 0.5) / (total + 0.5 * (distinct + 1))), worth["score"].to_numpy()])
        sums = []
        for ids, times in zip(held["ids"].to_pylist(), held["times"].to_pylist(), strict=True):
            numbers, n = unpacked(ids, times)
            sums.append(n.astype(float) @ values[numbers])
        known, base, score = np.array(sums).reshape(-1, 3).T
        return pa.table(
            [held["doc_id"], held["held_out"], held["n_tokens"], pa.array(np.rint(known).astype(np.int64)),
             pa.array([total] * len(known), pa.int64()), pa.array(base), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return held.groupBy("block").cogroup(worth.groupBy("word_block")).applyInArrow(
        rows,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
