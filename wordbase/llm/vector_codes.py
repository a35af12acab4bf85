"""Vector compression by product quantisation, with exact nearest entries from sliced and intersected bit masks.

Vectors are cut into consecutive parts; each part has a codebook, and a vector's code is the number of the nearest entry
for each part. Components are whole numbers (``floor(scale * x)``), and all arithmetic is exact.

How an entry is found: of each codebook the entries are sorted by every coordinate, and each place of that order carries a mask with a bit for
each entry before it. A vector's distance to a few entries beside it in one coordinate gives an initial radius. In each coordinate
the entries within the radius are a range of the order; the masks at its ends differ in just their bits. The masks of all
coordinates ANDed leave a box around the ball of that radius, which holds every entry that can be nearest, equally near ones
included; their distances are computed, and the smallest number wins.

How it runs: the entries, of a size that depends on ``entries`` and the length of a vector alone, go to all tasks; a round is one pass in which each task
sums its vectors by entry, and these sums are added up by a shuffle. The driver sees codebooks only. Sums travel in limbs of 60 bits,
so nothing overflows.

Defined results: a vector that is null or holds a null or a number that is not finite has no row. The length of vectors is the most
frequent one (the shortest of equally frequent ones); a vector of another length keeps its row, without code and
error, and teaches nothing. A length that is no multiple of ``parts`` is cut as evenly as it goes. Codebooks start from the smallest distinct ids; of rows with equal ids the
smallest vector counts, and a null id counts as the largest. Repeated rows get a row each. Fewer ids than ``entries`` make a
shorter codebook. An error, or a sum of errors, too large for a long is null. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.llm.common import arrow_rows
from wordbase.operators.keyed import spread_join
from wordbase.runtime import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BESIDE = 8  #: entries that are tried for the initial radius
LIMB = 60
LONG = 1 << 63

Books = list[np.ndarray]  #: for each part an array of entries by position, of longs, or of Python's integers where longs do not do


class Slices:
    """One codebook, sorted by each coordinate, with the mask of the entries before each place."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        number = np.arange(n)
        bit = np.zeros((n, -(-n // 64)), np.uint64)
        bit[number, number // 64] = np.uint64(1) << (number % 64).astype(np.uint64)
        self.order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = [entries[o, d] for d, o in enumerate(self.order)]
        self.before = np.zeros((width, n + 1, bit.shape[1]), np.uint64)
        self.before[:, 1:] = np.bitwise_or.accumulate(bit[self.order], axis=1)
        self.every = np.bitwise_or.reduce(bit, axis=0)
        self.widest = int(np.argmax([int(s[-1] - s[0]) for s in self.sorted])) if width else None

    @cached_property
    def unbounded(self) -> Slices:
        return Slices(self.entries.astype(object))

    def radius(self, x: np.ndarray) -> np.ndarray:
        """For each vector a whole number that is no less than its distance to some entry."""
        place = np.searchsorted(self.sorted[self.widest], x[:, self.widest])
        beside = np.clip(place[:, None] + np.arange(-(BESIDE // 2), BESIDE // 2), 0, len(self.entries) - 1)
        least = ((x[:, None, :] - self.entries[self.order[self.widest][beside]]) ** 2).sum(2).min(1)
        if x.dtype == object:
            return np.array([math.isqrt(v) + 1 for v in least], object)
        return np.sqrt(least.astype(float)).astype(np.int64) + 2

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, entries) of all entries in the box of the initial radius, by row and entry."""
        mask = np.repeat(self.every[None], len(x), axis=0)
        if self.widest is not None:
            radius = self.radius(x)
            for values, before, own in zip(self.sorted, self.before, x.T, strict=True):
                low = np.searchsorted(values, own - radius, "left")
                high = np.searchsorted(values, own + radius, "right")
                mask &= before[high] & ~before[low]
        return np.nonzero(np.unpackbits(mask.astype("<u8").view(np.uint8), axis=1, bitorder="little"))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest entry of each vector, the smallest of equally near ones, and its squared distance."""
        n, width = self.entries.shape
        step = max(1, 500_000 // (n * max(width, 1)))  # so that differences stay in the processor's cache
        found, far = np.empty(len(x), np.int64), np.empty(len(x), x.dtype)
        for i in range(0, len(x), step):
            some = x[i : i + step]
            row, entry = self.candidates(some)
            apart = some[row] - self.entries[entry]
            distance = np.einsum("ij,ij->i", apart, apart) if x.dtype != object else (apart**2).sum(1) if width else np.zeros(len(row), object)
            starts = np.searchsorted(row, np.arange(len(some)))
            least = np.minimum.reduceat(distance, starts)
            far[i : i + step] = least
            found[i : i + step] = np.minimum.reduceat(np.where(distance == least[row], entry, n), starts)
        return found, far


def _most(width: int) -> int:
    """The largest component for which squared distances are sure to fit a long."""
    return math.isqrt((1 << 60) // max(width, 1))


def _whole(values: np.ndarray, scale: int, width: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Which vectors have small components; the whole components of these, and of the others as Python's integers."""
    most = _most(width)
    small = (np.abs(values) < most / scale - 1).all(axis=1)
    large = [[math.floor(v * scale) if abs(v) < 1 << 52 else int(v) * scale for v in row] for row in values[~small].tolist()]
    return small, np.floor(values[small] * scale).astype(np.int64), large


def _cuts(length: int, parts: int) -> list[int]:
    return [length * i // parts for i in range(parts + 1)]


def _book(rows: list[list[int]], width: int) -> np.ndarray:
    most = _most(width)
    kind = np.int64 if all(abs(v) <= most for row in rows for v in row) else object
    return np.array(rows, kind).reshape(len(rows), width)


class Coder:
    """Codes of vectors by given books; built once for each task."""

    def __init__(self, books: Books, scale: int):
        self.scale = scale
        self.slices = [Slices(b) for b in books]
        self.cuts = np.cumsum([0, *(b.shape[1] for b in books)]).tolist()

    def code(self, column: pa.Array) -> list[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """For vectors with small components and for the others: (rows, components, code of each part, error)."""
        length = self.cuts[-1]
        values = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), length)
        small, whole, large = _whole(values, self.scale, max(s.entries.shape[1] for s in self.slices))
        made = []
        for rows, x, wide in ((np.flatnonzero(small), whole, False), (np.flatnonzero(~small), np.array(large, object).reshape(len(large), length), True)):
            codes, error = [], np.zeros(len(rows), object)
            for i, own in enumerate(self.slices):
                wide_part = wide or own.entries.dtype == object
                part = x[:, self.cuts[i] : self.cuts[i + 1]]
                found, far = (own.unbounded if wide_part else own).nearest(part.astype(object) if wide_part else part)
                codes.append(found)
                error = error + far.astype(object)
            made.append((rows, x, codes, error))
        return made


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    x = vector.cast("array<double>")
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def _vectors(table: DataFrame, length: int | None = None) -> DataFrame:
    rows = table.select(table["vec_id"].cast("long").alias("vec_id"), table["embedding"].cast("array<double>").alias("embedding"), table["label"].alias("label"))
    rows = rows.where(usable(F.col("embedding")))
    return rows if length is None else rows.where(F.size("embedding") == length)


def first_books(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> Books:
    """Codebooks of the vectors with the smallest ids; none if there is no vector."""
    vectors = _vectors(table)
    common = vectors.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return []
    length = common["n"]
    rows = _vectors(table, length)
    ids = [r["vec_id"] for r in rows.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    chosen = rows.where(F.col("vec_id").isin([i for i in ids if i is not None]) | (F.lit(None in ids) & F.col("vec_id").isNull()))
    found = chosen.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy(F.asc_nulls_last("vec_id")).collect()
    whole = [[math.floor(v * scale) if abs(v) < 1 << 52 else int(v) * scale for v in r["embedding"]] for r in found]
    cuts = _cuts(length, parts)
    return [_book([row[a:b] for row in whole], b - a) for a, b in zip(cuts, cuts[1:])]


def _limbs(value: int) -> list[int]:
    """A whole number as limbs; the last one has the sign."""
    limbs = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        limbs.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*limbs, value]


_SUM = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("position", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])


def moved(table: DataFrame, books: Books, scale: int = SCALE) -> Books:
    """One round: every entry becomes the mean, rounded down, of the parts nearest to it; an entry without any stays."""
    shared = table.sparkSession.sparkContext.broadcast(books)

    def rows(batches):
        coder = Coder(shared.value, scale)
        # the place after the last position counts the parts
        sums = [np.zeros((len(b), b.shape[1] + 1), object) for b in shared.value]
        for batch in batches:
            for _, x, codes, _ in coder.code(batch["embedding"]):
                for i, code in enumerate(codes):
                    own = np.column_stack([x[:, coder.cuts[i] : coder.cuts[i + 1]], np.ones(len(x), np.int64)])
                    batch_sum = np.zeros(sums[i].shape, x.dtype)
                    np.add.at(batch_sum, code, own)
                    sums[i] += batch_sum.astype(object)
        made = [
            (part, entry, position, limb, value)
            for part, total in enumerate(sums)
            for entry in np.flatnonzero(total[:, -1]).tolist()
            for position, v in enumerate(total[entry])
            for limb, value in enumerate(_limbs(int(v)))
        ]
        for i in range(0, len(made), 10_000):
            columns = zip(*made[i : i + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUM, strict=True)], schema=_SUM)

    vectors = _vectors(table, sum(b.shape[1] for b in books)).select("embedding")
    parts = arrow_rows(vectors, rows, "part int, entry int, position int, limb int, value long")
    total = parts.groupBy("part", "entry", "position", "limb").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in total.collect():  # of the size of the codebooks
        own = sums.setdefault((r["part"], r["entry"]), {})
        own[r["position"]] = own.get(r["position"], 0) + (int(r["value"]) << (LIMB * r["limb"]))
    new = []
    for part, book in enumerate(books):
        width = book.shape[1]
        entries = [[int(v) for v in entry] for entry in book]
        for entry in range(len(entries)):
            if (part, entry) in sums:
                own = sums[part, entry]
                entries[entry] = [own[p] // own[width] for p in range(width)]
        new.append(_book(entries, width))
    return new


def fit(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books:
    """Codebooks of ``table`` (vec_id, embedding)."""
    books = first_books(table, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = moved(table, books, scale)
    return books


def encode(table: DataFrame, books: Books, scale: int = SCALE) -> DataFrame:
    """A row (vec_id, label, codes, error) for each usable vector; codes and error are null where its length is not that of the books."""
    schema = "vec_id long, codes array<int>, error decimal(38,0)"
    whole = _vectors(table)
    length = sum(b.shape[1] for b in books) if books else -1
    fits = whole.where(F.size("embedding") == length)
    label = table.schema["label"].dataType
    others = whole.where(F.size("embedding") != length).select(
        "vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("decimal(38,0)").alias("error")
    )
    if not books:
        return others
    shared = table.sparkSession.sparkContext.broadcast(books)

    def rows(batches):
        coder = Coder(shared.value, scale)
        for batch in batches:
            codes, error = np.empty((batch.num_rows, len(shared.value)), np.int32), np.empty(batch.num_rows, object)
            for own, _, found, far in coder.code(batch["embedding"]):
                codes[own], error[own] = np.column_stack(found), far
            flat = pa.array(codes.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32)), flat)
            # Spark's long is as far as errors are told apart
            longs = pa.array([int(e) if e < LONG else None for e in error], pa.int64()).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], lists, longs], names=["vec_id", "label", "codes", "error"])

    coded = arrow_rows(fits, rows, schema.replace("codes", f"label {label.simpleString()}, codes", 1))
    return coded.unionByName(others)


def digest(books: Books) -> str:
    """SHA-256 of all entries, as decimal numbers by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for book in books for v in book.ravel()).encode()).hexdigest()


def code_report(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """A row for each usable vector: vec_id, code (two hex digits a part), error, label_error and codebooks_sha256."""
    books = fit(table, parts, entries, rounds, scale)
    key = F.struct(F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("name"))
    coded = encode(table, books, scale).select("vec_id", "codes", "error", key["none"].alias("label_none"), key["name"].alias("label_name"))
    coded = stored(coded, "codes")
    on = ["label_none", "label_name"]
    sums = stored(coded.groupBy(*on).agg(F.sum("error").alias("label_error")), "label_errors")
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return spread_join(coded, sums, on).select(
        "vec_id", F.array_join(digits, "").alias("code"), F.col("error").try_cast("long").alias("error"),
        F.col("label_error").try_cast("long").alias("label_error"), F.lit(digest(books)).alias("codebooks_sha256"),
    )
