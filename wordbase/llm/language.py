"""Language identification with a string kernel.

The kernel of two texts counts the n-grams (1 to 4 bytes of UTF-8) that both have, whatever their number, over the
geometric mean of the numbers each has. Labelled documents are sampled evenly by label; some of them are
landmarks. Kernels with the landmarks, whitened by their own kernel matrix (Nyström), are the features of a ridge
regression, one language against the rest. Landmarks are kept as postings, n-gram by n-gram.

The kernel with the landmarks is linear in a text's n-grams, so for prediction of up to ``FOLDED`` labels the product of
landmarks, whitening and regression is formed once: one row of weights for each n-gram of a landmark, and the number of
landmarks costs nothing. For more labels that table would grow with both; then the kernel with the landmarks is
taken from the postings and multiplied by one row of weights for each landmark, which gives the same values.

Bounds: ``SAMPLE`` labelled rows are learned from and ``LANDMARKS`` of them are landmarks, but at least one row and one landmark of
every label; labels are counted over all rows. Everything else covers all rows and whole texts.

Whether a text is in a learned language at all does not go by the score, whose least value depends on the number of labels,
but by the share of its n-grams that the landmarks have. Sample rows, and pieces of ``PIECES`` characters of them, show which
shares the texts of each label have at each length, a landmark being compared with the others only. A text is unknown if
the share it lacks is more than ``MARGIN`` times the largest that was seen for its label at about its length. Where nothing
was seen so short, nothing is rejected, and hardly anything that is like a label with a single row. Keys and numbers say
nothing about the language, so a text that fails is judged again without its words with digits.

Defined results: a null text, or one without a letter, is ``und`` with score 0. A null label is not learned from. A table
without labelled rows gives ``und`` everywhere. Repeated rows get a row each, an empty table none. Other columns
are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordbase.llm.common import arrow_rows
from wordbase.runtime import stored

SAMPLE = 2000
LANDMARKS = 320
FOLDED = 64
RIDGE = 1e-3
LONGEST = 4
UNKNOWN = "und"
#: Documents below this score go too; none, as what a low score is depends on the number of labels.
LEAST_SCORE = 0.0
PIECES = (10, 20, 40, 80, 160, 320, 640, 1280)
MARGIN = 2.0
LENGTHS = 33
BLOCK = 200_000  #: n-grams of the texts that are scored together

_OTHERS = re.compile(r"[\W\d_]+")
_DIGITS = re.compile(r"\w*\d\w*")


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of the letters of a text, sorted; empty if it has none."""
    letters = _OTHERS.sub(" ", text.lower()).strip()
    if not letters.isascii():
        # numbers that are not decimal ones are no letters
        numbers = {ord(c): " " for c in set(letters) if not c.isalpha()}
        if len(numbers) > 1 or numbers and " " not in letters:
            letters = " ".join(letters.translate(numbers).split())
    if not letters:
        return np.empty(0, np.uint32)
    b = np.frombuffer(f" {letters} ".encode(), np.uint8).astype(np.uint32)
    parts = [b]
    for n in range(2, LONGEST + 1):  # no byte is zero, so n-grams of different length differ
        parts.append(parts[-1][:-1] << np.uint32(8) | b[n - 1 :])
    found = np.concatenate(parts)
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


class Postings:
    """The n-grams of texts, and for each the texts that have it."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        of = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
        every = np.concatenate(texts)
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.starts, self.texts = np.append(first, len(every)), of[order]
        self.roots = np.sqrt([len(t) for t in texts])

    def places(self, own: np.ndarray) -> np.ndarray:
        """Where the n-grams of a text that are known are among them."""
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        return at[self.grams[at] == own]

    def product(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The sparse matrix of a block of texts by known n-grams: (rows, columns) of its ones."""
        own = np.concatenate(texts)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        known = self.grams[at] == own
        return row[known], at[known]

    def kernel(self, own: np.ndarray) -> np.ndarray:
        """Kernels of a text with each of the texts."""
        at = self.places(own)
        size = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(size)
        entries = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - size), size)
        return np.bincount(self.texts[entries], minlength=len(self.roots)) / (self.roots * np.sqrt(max(1, len(own))))

    def folded(self, weights: np.ndarray, block: int = 1 << 14) -> np.ndarray:
        """Rows of weights of the texts, added up for each n-gram."""
        rows = (weights / self.roots[:, None]).astype(np.float32)
        out = np.empty((len(self.grams), rows.shape[1]), np.float32)
        for i in range(0, len(out), block):
            starts = self.starts[i : i + block + 1]
            out[i : i + block] = np.add.reduceat(rows[self.texts[starts[0] : starts[-1]]], starts[:-1] - starts[0], axis=0)
        return out

    def unknown(self, own: np.ndarray, itself: bool) -> float:
        """The share of the n-grams of a text that no text has, or no other text than ``itself``, one of them."""
        at = self.places(own)
        known = np.count_nonzero(self.starts[at + 1] - self.starts[at] > 1) if itself else len(at)
        return 1 - known / len(own)


@dataclass
class Model:
    labels: list[str]
    marks: Postings
    weights: np.ndarray  #: a row for each n-gram, or for each landmark, and a column for each label
    intercept: np.ndarray
    lacking: np.ndarray  #: by label and length: the largest share of unknown n-grams that passes

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Regression values of a batch of texts, given as their n-grams.

        A block of texts is a sparse matrix of the n-grams they have, multiplied by the rows of weights; or by the landmarks' postings and then by the weights."""
        out = np.tile(self.intercept, (len(texts), 1))
        sizes = np.array([len(own) for own in texts], np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + BLOCK, "right")))
            n = last - first
            row, at = self.marks.product(texts[first:last])
            norms = np.sqrt(np.maximum(sizes[first:last], 1))
            if len(self.labels) <= FOLDED:
                sums = np.column_stack([np.bincount(row, self.weights[at, label], n) for label in range(len(self.labels))])
            else:
                size = self.marks.starts[at + 1] - self.marks.starts[at]
                runs = np.cumsum(size)
                entries = np.arange(runs[-1] if len(runs) else 0) + np.repeat(self.marks.starts[at] - (runs - size), size)
                width = len(self.marks.roots)
                shared = np.bincount(np.repeat(row, size) * width + self.marks.texts[entries], minlength=n * width).reshape(n, width)
                sums = (shared / self.marks.roots) @ self.weights
            out[first:last] += sums / norms[:, None]
            first = last
        return out

    def learned(self, text: str, own: np.ndarray, label: int) -> bool:
        """Whether a text with these n-grams is in a learned language, or what is left of it without words with digits."""
        if not len(own):
            return False
        if self.marks.unknown(own, False) <= self.lacking[label, _length(own)]:
            return True
        rest = grams(_DIGITS.sub(" ", text))
        return len(rest) > 0 and bool(self.marks.unknown(rest, False) <= self.lacking[label, _length(rest)])


def _length(own: np.ndarray) -> int:
    """The number of n-grams of a text in powers of two."""
    return min(LENGTHS - 1, len(own).bit_length())


def _lacking(rows: list[tuple[str, np.ndarray, list[np.ndarray]]], marks: Postings, labels: list[str]) -> np.ndarray:
    number = {lang: i for i, lang in enumerate(labels)}
    seen = np.full((len(labels), LENGTHS), -1.0)
    for i, (lang, own, pieces) in enumerate(rows):
        for part in [own, *pieces]:
            at = number[lang], _length(part)
            seen[at] = max(seen[at], marks.unknown(part, i < len(marks.roots)))
    out = np.ones_like(seen)  # shorter than anything seen
    for n in range(LENGTHS):
        before = out[:, n - 1] if n else np.ones(len(labels))
        # longer texts vary less; where a length was not seen, the next shorter one holds
        out[:, n] = np.where(seen[:, n] < 0, before, np.minimum(1.0, MARGIN * np.maximum(seen[:, n], seen[:, max(n - 1, 0)])))
    return out


def _pieces(text: str) -> list[np.ndarray]:
    """N-grams of a piece of each length from the middle of a text that is longer, from word to word."""
    found = []
    for n in PIECES:
        if n < len(text):
            start = (len(text) - n) // 2
            part = text[start : start + n]
            words = part.split(None, 1)[-1].rsplit(None, 1)[0] if part.strip() else ""
            found.append(grams(words))
    return [own for own in found if len(own)]


def _sample_rows(docs: DataFrame, sample: int) -> list[tuple[str, np.ndarray, list[np.ndarray]]]:
    """(lang, n-grams, those of pieces) of the sampled rows."""
    known = docs.where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    counts = stored(known.groupBy("lang").count(), "labels")
    labels = counts.count()
    if not labels:
        return []
    each = max(1, sample // labels)
    share = (F.lit(3.0 * each) + 20.0) / F.col("count")
    draw = F.xxhash64("doc_id", "text").bitwiseAND((1 << 52) - 1) / F.lit(float(1 << 52))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    few = known.select("doc_id", "lang", "text", draw.alias("draw")).join(F.broadcast(counts), "lang").where(F.col("draw") < share)
    few = few.withColumn("n", first).where(F.col("n") <= each)

    def rows(batches):
        for batch in batches:
            texts = batch["text"].to_pylist()
            own = [grams(t).tobytes() for t in texts]
            parts = [[p.tobytes() for p in _pieces(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], batch["n"], pa.array(own, pa.binary()), pa.array(parts, pa.list_(pa.binary()))],
                names=["lang", "n", "grams", "pieces"],
            )

    few = few.select("lang", F.col("n").cast("int").alias("n"), "text")
    found = arrow_rows(few, rows, "lang string, n int, grams binary, pieces array<binary>").collect()
    # in turn from each label, so that the first ones make landmarks
    return [
        (r["lang"], np.frombuffer(r["grams"], np.uint32), [np.frombuffer(p, np.uint32) for p in r["pieces"]])
        for r in sorted(found, key=lambda r: (r["n"], r["lang"]))
        if r["grams"]
    ]


def sampled(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, np.ndarray]]:
    """(lang, n-grams) of a sample of the rows with text and label, the same number for each label where there are enough."""
    return [(lang, own) for lang, own, _ in _sample_rows(docs, sample)]


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """A model of the labelled rows of ``docs`` (doc_id, text, lang); none if there are no such rows."""
    rows = _sample_rows(docs, sample)
    if not rows:
        return None
    labels = sorted({lang for lang, *_ in rows})
    marks = Postings([own for _, own, _ in rows[: max(landmarks, len(labels))]])
    kernel = np.stack([marks.kernel(own) for _, own, _ in rows])
    values, vectors = np.linalg.eigh(kernel[: len(marks.roots)])
    kept = values > 1e-6 * values[-1]
    whitening = vectors[:, kept] / np.sqrt(values[kept])
    features = np.column_stack([kernel @ whitening, np.ones(len(rows))])
    targets = np.where(np.array([lang for lang, *_ in rows])[:, None] == np.array(labels), 1.0, -1.0)
    penalty = ridge * len(rows) * np.eye(features.shape[1])
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(features.T @ features + penalty, features.T @ targets)
    weights = whitening @ solved[:-1]
    if len(labels) <= FOLDED:
        weights = marks.folded(weights)
    else:
        weights = weights.astype(np.float32)
    return Model(labels, marks, weights, solved[-1], _lacking(rows, marks, labels))


def language(docs: DataFrame, model: Model | None) -> Column:
    """A struct of ``lang``, ``score`` (0 to 1) and ``learned`` (see above) for the text of each row; nothing but the text is used."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, learned boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        own = [grams(t) if t else np.empty(0, np.uint32) for t in texts]
        if model is None:
            return pd.DataFrame({"lang": [UNKNOWN] * len(own), "score": 0.0, "learned": False})
        values = model.scores(own)
        best = values.argmax(axis=1) if len(own) else np.empty(0, int)
        some = np.array([len(g) > 0 for g in own], bool)
        score = np.clip((values[np.arange(len(own)), best] + 1) / 2, 0, 1)
        return pd.DataFrame(
            {
                "lang": [model.labels[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)],
                "score": np.where(some, score, 0.0),
                "learned": [model.learned(t, g, b) for t, g, b in zip(texts, own, best, strict=True)],
            }
        )

    return predicted(docs["text"])


def drop_unknown(docs: DataFrame, model: Model | None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is in one of the learned languages, with all their columns."""
    marked = docs.withColumn("__language", language(docs, model))
    return marked.where(F.col("__language.learned") & (F.col("__language.score") >= least)).drop("__language")
