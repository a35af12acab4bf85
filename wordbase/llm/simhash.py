"""Near copies by SimHash fingerprints, linked by meeting in the middle of a Hamming ball.

Two fingerprints that differ in ``2 h`` bits meet in a variant that is ``h`` bits from each. So every distinct fingerprint
emits all variants within half the radius, variants are shuffled, and those that collide are linked.
An odd radius has no middle: so the 64 bits are cut into four blocks, and each fingerprint emits its variants once
for each block, with that block left out. Of an odd number of differing bits, some block holds an odd
number, and without it an even number is left. For three bits that makes 4 * 49 variants for each fingerprint,
where two-bit balls on both sides would take 2,081. What is shuffled is a variant, the bits of the block and
which bit was flipped, 9 bytes; the fingerprint follows from these.

Fingerprints that collide with block ``b`` left out differ in at most ``2 h`` other bits, so they are within
the radius if they differ in at most one bit of the block. That is looked up value by value of the block,
never pair by pair, so a dense group costs its size and not its square. What remains is a
difference that lies within one block; that is looked up among fingerprints equal outside the block. Links are verified by
their distance.

Defined results: a null text is an empty one; texts without words have fingerprint zero and are linked like
others. A component without any id has a null component_id. Rows with equal ids each get a row. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.llm.common import arrow_rows, components, id_and_text, raw_texts, shuffle_partitions, without_rows
from wordbase.operators.keyed import spread_join
from wordbase.runtime import stored

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BLOCK = 16
#: Emitted variants that one task sorts at a time, 16 bytes each.
VARIANTS_A_TASK = 2_000_000


def fingerprint(text: bytes, n: int = SHINGLE_WORDS) -> int:
    """The majority of the bits of the XXH64 of all shingles, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    n = min(n, len(words))
    spans = zip(starts[: len(words) - n + 1].tolist(), (starts[n:] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 10_000):
        part = hashes[at : at + 10_000]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, check, fp) for each row: a hash of the text, and the fingerprint's bits as a signed long."""

    def rows(batches):
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in raw_texts(batch["text"])], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["check"], pa.array(found.view(np.int64))], names=["doc_id", "check", "fp"]
            )

    return arrow_rows(id_and_text(docs).withColumn("check", F.xxhash64("text")), rows, "doc_id long, check long, fp long")


def _without(fps: np.ndarray, block: int) -> np.ndarray:
    """The 48 bits beside one block."""
    low = fps & np.uint64((1 << BLOCK * block) - 1)
    return low | (fps >> np.uint64(BLOCK * (block + 1)) << np.uint64(BLOCK * block)) if block < 3 else low


def _value(fps: np.ndarray, block: int) -> np.ndarray:
    return fps >> np.uint64(BLOCK * block) & np.uint64((1 << BLOCK) - 1)


def _emit(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Variants for each block that is left out. The upper bits of a key tell the block.

    The second array has the bits of the block and, above them, the flipped bit plus one.
    """
    flips = range(49 if radius == 3 else 1)
    masks = np.array([1 << (f - 1) if f else 0 for f in flips], np.uint64)
    tags = np.arange(len(masks), dtype=np.uint64) << np.uint64(BLOCK)
    keys = [(_without(fps, b)[:, None] ^ masks) | np.uint64(b << 48) for b in range(4)]
    rest = [_value(fps, b)[:, None] | tags for b in range(4)]
    return np.concatenate([k.ravel() for k in keys]), np.concatenate([r.ravel() for r in rest])


def _emitted_by(keys: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The fingerprints that emitted these variants."""
    flip = rest >> np.uint64(BLOCK)
    masks = np.array([1 << (f - 1) if f else 0 for f in range(49)], np.uint64)
    own = (keys & np.uint64((1 << 48) - 1)) ^ masks[flip]
    value = rest & np.uint64((1 << BLOCK) - 1)
    out = np.empty_like(keys)
    for b in range(4):
        here = keys >> np.uint64(48) == b
        low = own[here] & np.uint64((1 << BLOCK * b) - 1)
        high = (own[here] ^ low) << np.uint64(BLOCK) if b < 3 else np.uint64(0)
        out[here] = low | value[here] << np.uint64(BLOCK * b) | high
    return out


def _found(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted number is in sorted ``values``; -1: nowhere."""
    at = np.searchsorted(values, wanted)
    at[at == len(values)] = 0
    return np.where(values[at] == wanted, at, -1)


def _collisions(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints within ``radius`` that share a key."""
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    group = np.cumsum(new) - 1
    several = (np.bincount(group) > 1)[group]
    keys, fps = keys[several], fps[several]
    group = np.unique(keys, return_inverse=True)[1].astype(np.uint64)
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]

    def link(left: np.ndarray, right: np.ndarray) -> None:
        near = (left != right) & (np.bitwise_count(left ^ right) <= radius)
        a.append(left[near])
        b.append(right[near])

    for block in range(4):
        here = keys >> np.uint64(48) == block
        if not here.any():
            continue
        key, own, at = keys[here], fps[here], group[here] << np.uint64(BLOCK)
        spot = at | _value(own, block)
        order = np.argsort(spot, kind="stable")
        spot, key, own = spot[order], key[order], own[order]
        same = spot[1:] == spot[:-1]
        link(own[1:][same], own[:-1][same])
        spots, first = np.unique(spot, return_index=True)
        for bit in range(BLOCK):
            to = _found(spots, spots ^ np.uint64(1 << bit))
            link(own[first[to >= 0]], own[first[to[to >= 0]]])
        if radius == 3:  # three bits within the block: equal beside it, so both are the middle of the ball
            middle = _without(own, block) == key & np.uint64((1 << 48) - 1)
            spots, own = spot[middle], own[middle]
            crowd = np.concatenate([[False], spots[1:] >> np.uint64(BLOCK) == spots[:-1] >> np.uint64(BLOCK)]) if len(spots) else np.empty(0, bool)
            crowd |= np.concatenate([crowd[1:], [False]]) if len(crowd) else crowd
            spots, own = spots[crowd], own[crowd]
            if len(spots):
                for i, j, k in combinations(range(BLOCK), 3):
                    to = _found(spots, spots ^ np.uint64(1 << i | 1 << j | 1 << k))
                    link(own[to >= 0], own[to[to >= 0]])
    return np.concatenate(a), np.concatenate(b)


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of column ``fp`` wherever a chain of pairs within ``radius`` does."""
    if radius not in (1, 3):
        raise ValueError("the radius is 1 or 3 bits")
    spark = fps.sparkSession

    def emit(batches):
        for batch in batches:
            own = batch["fp"].to_numpy().view(np.uint64)
            for at in range(0, len(own), 2_000):
                keys, rest = _emit(own[at : at + 2_000], radius)
                # 50 bits of key and 14 of the rest; the other 8 go beside
                packed = keys | rest << np.uint64(50)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(packed.view(np.int64)), pa.array((rest >> np.uint64(14)).astype(np.uint8).view(np.int8))], names=["packed", "more"]
                )

    def meet(batches):
        parts = [(b["packed"].to_numpy(), b["more"].to_numpy()) for b in batches]
        if parts:
            packed, more = (np.concatenate(c) for c in zip(*parts, strict=True))
            packed = packed.view(np.uint64)
            keys = packed & np.uint64((1 << 50) - 1)
            rest = packed >> np.uint64(50) | more.view(np.uint8).astype(np.uint64) << np.uint64(14)
            a, b = _collisions(keys, _emitted_by(keys, rest), radius)
            pairs = np.unique(np.stack([a, b], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, i].copy().view(np.int64)) for i in (0, 1)], names=["a", "b"])

    variants = fps.count() * 4 * (49 if radius == 3 else 1)
    parts = max(shuffle_partitions(spark), -(-variants // VARIANTS_A_TASK))
    emitted = arrow_rows(fps.select("fp"), emit, "packed long, more byte")
    key = F.col("packed").bitwiseAND((1 << 50) - 1)
    return arrow_rows(emitted.repartition(parts, key), meet, "a long, b long")


def near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, check (a hash of the text)."""
    prints = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = components(near_links(distinct, radius))
    groups = linked.join(distinct, linked["node"] == distinct["fp"]).select("fp", "root", "first")
    ids = groups.groupBy("root").agg(F.min("first").alias("smallest"))
    several = groups.join(ids, "root").select("fp", "smallest")
    component = distinct.join(several, "fp", "left").select(
        "fp", F.when(F.col("smallest").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id")
    )
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    # a group of copies may be a third of all rows with one fingerprint
    return spread_join(prints, component, "fp").select("doc_id", fingerprint, "component_id", "check")


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all their columns.

    Rows without an id stay. Rows are told apart by id and text.
    """
    own = docs.select("doc_id", "text")
    groups = near_copies(own, words, radius).where("doc_id <> component_id")
    return without_rows(docs, groups.select("doc_id", "check"))
