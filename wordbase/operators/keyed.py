"""Helpers for tables with one row per key."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordbase.schemas import rows_to_table

PIECES_A_PARTITION = 16


def as_keys(table: DataFrame, words: DataFrame | list[str], name: str = "word") -> DataFrame:
    """Distinct look-up keys out of a list of words or a table with a ``word`` column."""
    if isinstance(words, DataFrame):
        return words.select(F.col("word").alias(name)).distinct()
    if not isinstance(words, (list, tuple)):
        raise ValueError("expected a list of words or a table with a word column")
    return listed(table, dict.fromkeys(words), name)


def listed(table: DataFrame, words: Iterable[str], name: str = "word") -> DataFrame:
    """A driver-side list of words as a table, repeats kept."""
    schema = T.StructType([T.StructField(name, T.StringType())])
    return rows_to_table(table.sparkSession, ((word,) for word in words), schema)


def matching(table: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``table`` whose key occurs in ``keys``.

    Spark broadcasts ``keys`` when their size is known to be small, and then a huge table is
    scanned without being shuffled. That is why look-ups narrow the table this way first: the
    outer join that follows cannot broadcast the side whose rows it has to keep.
    """
    on = [on] if isinstance(on, str) else on
    return table.join(keys.select(*on), on, "left_semi")


def without(table: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``table`` whose key does not occur in ``keys``."""
    on = [on] if isinstance(on, str) else on
    return table.join(keys.select(*on), on, "left_anti")


def row_key(on: list[str]) -> Column:
    """One number for the key columns, whatever their types; null only if a key is."""
    keyless = reduce(or_, (F.col(c).isNull() for c in on))
    return F.when(~keyless, F.xxhash64(*(F.col(c).cast("string") for c in on)))


def free_names(names: list[str], *tables: DataFrame) -> list[str]:
    """The names, with as many underscores before them as it takes to be no column of the tables."""
    taken = {c.lower() for table in tables for c in table.columns}
    free = []
    for name in names:
        name = f"_{name}"
        while name in taken:
            name = f"_{name}"
        free.append(name)
    return free


def hot_keys(table: DataFrame, on: list[str], size: str | None = None) -> tuple[dict[int, list[int | None]], int]:
    """Keys with many rows for one shuffle partition, by the number of pieces each needs; and the size of a piece.

    ``size`` names a column of ``table`` with counts made before; without it the rows are counted.

    Pieces hold a sixteenth of what a partition gets on average, so that they spread evenly; a key with more
    rows is hot. So there are fewer hot keys than 16 times the partitions, which bounds what is collected here.
    Numbers of pieces are powers of two; all together they are at most 32 times the partitions. One pass
    counts the keys and their total.
    """
    parts = PIECES_A_PARTITION * int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        table.select(row_key(on).alias("key"), *([F.col(size).alias("size")] if size else []))
        .rollup("key")
        .agg((F.sum("size") if size else F.count("*")).alias("size"), F.grouping("key").alias("all"))
        .orderBy(F.desc("all"), F.desc("size"))
        .limit(parts)
        .collect()
    )
    if not counts or not counts[0]["size"]:
        return {}, 1
    target = max(1, -(-counts[0]["size"] // parts))
    pieces: dict[int, list[int | None]] = {}
    for row in counts[1:]:
        if row["size"] > target:
            pieces.setdefault(1 << (-(-row["size"] // target) - 1).bit_length(), []).append(row["key"])
    return pieces, target


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    sizes_of: DataFrame | None = None,
    size: str | None = None,
    repeats: bool = False,
) -> DataFrame:
    """Join a table whose keys repeat, possibly a third of it with the same key, to one with
    unique keys (for ``left_semi`` and ``left_anti`` the keys may repeat on both sides).

    Keys are counted first, on ``left`` or on the table ``sizes_of``, by rows or by its column ``size``. Rows of hot
    keys are cut by hash into pieces, and the right side's row is copied to each piece; rows without a
    key match nothing and are only spread. Without a hot key this is a plain join. Adaptive execution
    cannot be relied on for this: it splits a side only if the other comes straight out of a shuffle, not out
    of an aggregate.

    ``repeats`` says that whole rows may repeat, as in a list of titles: equal rows are then counted before the join, cut
    into pieces by their number, and repeated after it.

    Only hot rows of the right side are read again for their copies. Both sides keep a size Spark can estimate, so Spark still
    broadcasts a short side instead of shuffling the other; the pieces of a key are then joined in different tasks all the same.
    """
    on = [on] if isinstance(on, str) else on
    hot, target = hot_keys(left if sizes_of is None else sizes_of, on, size)
    if not hot:
        return left.join(right, on, how)

    def pieces(known: bool) -> Column:
        """The number of pieces of a row's key."""
        value = F.lit(1)
        for n, keys in hot.items():
            given = [k for k in keys if k is not None]
            if given:
                value = F.when(row_key(on).isin(given), n).otherwise(value)
            if known and None in keys:
                value = F.when(row_key(on).isNull(), n).otherwise(value)
        return value

    names, cut = left.columns, left
    piece, times, part, start, turn = free_names(["piece", "times", "part", "start", "turn"], left, right)
    if repeats:
        counted = left.groupBy(*names).agg(F.count("*").alias(times))
        parts = F.posexplode(F.sequence(F.lit(1).cast("long"), F.col(times), F.lit(target).cast("long")))
        cut = counted.select("*", parts.alias(part, start)).withColumn(
            times, F.least(F.col(times) - F.col(start) + 1, F.lit(target).cast("long"))
        ).drop(start)
    shift = F.col(part) if repeats else F.lit(0)
    # halves of hashes, so that adding the part cannot overflow
    number = F.pmod(F.shiftright(F.xxhash64(*names), 1) + shift, pieces(True)).cast("int")
    cut = cut.withColumn(piece, number)
    # the copies are dealt out by a shuffle of their own: where Spark broadcasts the left side, they would stay in one task
    is_hot = F.coalesce(row_key(on).isin([k for keys in hot.values() for k in keys if k is not None]), F.lit(False))
    copies = right.where(is_hot).withColumn(piece, F.explode(F.sequence(F.lit(0), pieces(False) - 1)))
    copies = copies.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), *on, piece)
    copied = right.where(~is_hot).withColumn(piece, F.lit(0)).unionByName(copies)
    joined = cut.join(copied, [*on, piece], how)
    if repeats:
        joined = joined.withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).drop(turn, times, part)
    return joined.drop(piece)


def look_up(keys: DataFrame, table: DataFrame, on: str = "word") -> DataFrame:
    """Every key with the table's columns, null where the table lacks the key."""
    return keys.join(matching(table, keys, on), on, "left")


def one_per_key(df: DataFrame, key: str, order: str, last: bool = True) -> DataFrame:
    """The last (or first) row of each key by ``order``.

    An aggregate, not a window: each map task reduces its rows to one per key before the
    shuffle, so a key that holds a large part of the table is no hot spot. Equal orders are
    decided by the remaining columns, so the result does not depend on the run.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    whole = F.struct(order, *rest)
    picked = (F.max if last else F.min)(whole).alias("picked")
    return df.groupBy(key).agg(picked).select(
        *(F.col(c) if c == key else F.col(f"picked.`{c}`").alias(c) for c in df.columns)
    )


def last_given(value: Column, order: list[str]) -> Column:
    """Aggregate: the non-null value that comes last by ``order``."""
    return F.max(F.when(value.isNotNull(), F.struct(*order, value.alias("value"))))["value"]
