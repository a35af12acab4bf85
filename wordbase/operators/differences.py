"""What changed between two states of a table with one row per key, and the change applied to a third.

A state is the key with two hashes of the other columns, so comparing two states shuffles 16 bytes a row beside the
key, never the rows themselves; only rows that changed are fetched from the new table. A refresh costs the changes then, not
the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordbase.operators.keyed import free_names, matching, without

ADDED, CHANGED, GONE = "added", "changed", "gone"
_SALTS = (0, 1)


def state_of(table: DataFrame, key: str) -> DataFrame:
    """The key and two hashes of each row, ``hash0`` and ``hash1``; a row without a key has no state.

    Hashing passes over nulls, so which columns are null is hashed too.
    """
    others = [c for c in table.columns if c != key]
    nulls = [F.isnull(c) for c in others]
    hashes = [F.xxhash64(F.lit(salt), *nulls, *others).alias(f"hash{salt}") for salt in _SALTS]
    return table.where(F.col(key).isNotNull()).select(key, *hashes)


def difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of the table ``after`` that the state ``before`` lacks or has otherwise, and keys it no longer has: the columns of
    ``after``, null for keys that are gone, and ``change``.

    ``after`` is read once for its state and once for the rows that changed, which are few or many; Spark knows which by their size.
    """
    now = state_of(after, key)
    old, new = before.alias("old"), now.alias("new")
    both = old.join(new, key, "full")
    same = F.lit(True)
    for salt in _SALTS:
        same = same & F.col(f"old.hash{salt}").eqNullSafe(F.col(f"new.hash{salt}"))
    kind = F.when(F.col("old.hash0").isNull(), ADDED).when(F.col("new.hash0").isNull(), GONE).otherwise(CHANGED)
    name = free_names(["change"], after)[0]
    keys = both.where(~same).select(key, kind.alias(name))
    rows = matching(after, keys, key)
    # every key of the difference that ``after`` has is in ``rows``, so this keeps gone ones only as such
    return keys.join(rows, key, "left").select(*after.columns, F.col(name).alias("change"))


def apply_difference(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``table`` with the changes made: rows of keys that changed are replaced, those of keys that are gone are left out."""
    new = changes.where(F.col("change") != GONE).select(*table.columns)
    return without(table, changes, key).unionByName(new)


def difference_report(changes: DataFrame) -> DataFrame:
    """One row: how many keys were added, changed and gone."""
    return changes.agg(*(F.count_if(F.col("change") == kind).alias(kind) for kind in (ADDED, CHANGED, GONE)))
