"""Packing of token sequences: shortest pack first, over the histogram of lengths.

Documents are cut at ``max_len`` ids. The lengths of the pieces are counted, and lengths are placed
longest first, each into the pack with the most room left; what is kept of packs are patterns (which lengths, how
many of each) with a count. A length that fits nowhere opens packs that hold it as often as it fits.
Patterns are bounded by ``max_len`` alone, whatever the number of documents. Pieces
then get their place by rank: the n-th piece of a length has the n-th place for that length. Ranks
come from counts per (length, bucket) and a row number within each, so that a length with a third of all pieces
is numbered in as many tasks as there are buckets.

Defined results: a null or empty text is one piece with the closing id alone. Rows with equal or null ids are
documents of their own. An empty table gives no rows. Other columns are not looked at.

Ids come from ``tiktoken``, which refuses texts with a million blanks or line breaks in a row. Texts with a run of
``LONG_RUN`` or more are encoded by ``tokenizers``, which takes any and gives the same ids.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordbase.llm.common import arrow_rows, id_and_text, shuffle_partitions
from wordbase.runtime import stored

MAX_LEN = 2048
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

#: A fixed value: the pattern by which byte-level vocabularies of this kind part texts into words.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = 10_000
_LONG_RUN = re.compile(rf"\s{{{LONG_RUN}}}")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible bytes are themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> tiktoken.Encoding:
    """An encoder for the text of a byte-level vocabulary file; it gives the same ids as ``tokenizers``."""
    file, letters = json.loads(vocabulary), byte_letters()
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    ranks = {bytes(map(letters.__getitem__, t)): i for t, i in file["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("vocabulary", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=2)
def _any_text(vocabulary: str) -> Tokenizer:
    return Tokenizer.from_str(vocabulary)


def token_ids(vocabulary: str, text: str, closing_id: int) -> np.ndarray:
    if len(text) >= LONG_RUN and _LONG_RUN.search(text):
        ids = np.array(_any_text(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)
    else:
        encoder = _encoder(vocabulary)
        special = {s for s in encoder.special_tokens_set if s in text}
        ids = encoder.encode_to_numpy(text, allowed_special=special, disallowed_special=())
    return np.append(ids, np.uint32(closing_id)).astype("<u4", copy=False)


def cut_pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, closing_id: int = 1) -> DataFrame:
    """A row for each piece of at most ``max_len`` ids of each document."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def rows(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = token_ids(vocabulary.value, text, closing_id)
                for start in range(0, len(ids), max_len):
                    piece = ids[start : start + max_len]
                    out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 5)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return arrow_rows(id_and_text(docs), rows, PIECE)


def shortest_pack_first(histogram: dict[int, int], max_len: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (count, [(length, copies), ...]) for a histogram of lengths up to ``max_len``."""
    done: list[tuple[int, list[tuple[int, int]]]] = []
    open_packs: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # a heap: most room first
    order = 0

    def put(room: int, count: int, content: list[tuple[int, int]]) -> None:
        nonlocal order
        if count and room:
            order += 1
            heapq.heappush(open_packs, (-room, order, count, content))
        elif count:
            done.append((count, content))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and -open_packs[0][0] >= length:
                room, _, count, content = heapq.heappop(open_packs)
                used = min(count, left)
                put(-room, count - used, content)
                more = [*content[:-1], (length, content[-1][1] + 1)] if content[-1][0] == length else [*content, (length, 1)]
                put(-room - length, used, more)
                left -= used
            else:
                copies = max_len // length
                full, rest = divmod(left, copies)
                put(max_len - copies * length, full, [(length, copies)])
                put(max_len - rest * length, int(rest > 0), [(length, rest)])
                left = 0
    return done + [(count, content) for _, _, count, content in sorted(open_packs)]


def _places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, copies, first sequence, offset), sorted: where the ranks of a length go."""
    rows, taken, sequence = [], {}, 0
    for count, content in patterns:
        offset = 0
        for length, copies in content:
            rank = taken.get(length, 0)
            rows.append((length, rank, copies, sequence, offset))
            taken[length] = rank + count * copies
            offset += length * copies
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``pieces`` (see ``cut_pieces``) with sequence_id and offset."""
    spark = pieces.sparkSession
    buckets = shuffle_partitions(spark)
    bucket = F.pmod(F.xxhash64(*pieces.columns), F.lit(buckets))
    pieces = stored(pieces.withColumn("bucket", bucket), "pieces")
    sizes = stored(pieces.groupBy("length", "bucket").count(), "sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most max_len rows
    places = spark.sparkContext.broadcast(_places(shortest_pack_first(histogram, max_len)))

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    names = [f.split()[0] for f in PIECE.split(", ")]
    within = Window.partitionBy("length", "bucket").orderBy(*[n for n in names if n != "length"])
    ranked = (
        pieces.withColumn("n", F.row_number().over(within))
        .join(bases, ["length", "bucket"])
        .select(*names, (F.col("base") + F.col("n") - 1).alias("rank"))
    )

    def rows(batches):
        table = places.value
        keys = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = (batch[c].to_numpy() for c in ("length", "rank"))
            found = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            n = rank - found[:, 1]
            place = (found[:, 3] + n // found[:, 2], found[:, 4] + n % found[:, 2] * length)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), *map(pa.array, place)], names=[*names, "sequence_id", "offset"]
            )

    return arrow_rows(ranked, rows, f"{PIECE}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, closing_id: int = 1) -> DataFrame:
    return pack(cut_pieces(docs, tokenizer_path, max_len, closing_id), max_len)
