"""Column functions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of letters, digits and underscores counts as a word only if all of it is
# two or more ASCII letters. The boundaries are spelled out because the meaning of
# \b depends on the Java version; the possessive quantifier avoids backtracking.
WORD_PATTERN = r"(?<![\p{L}\p{N}_])[a-z]{2,}+(?![\p{L}\p{N}_])"


def words(text: Column) -> Column:
    """All words of a text in order, repeats kept, as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def word_length(word: Column) -> Column:
    """Length in characters."""
    return F.length(word)


def capitalised(label: Column) -> Column:
    """First letter upper-case and the rest lower-case, whatever blanks are inside."""
    return F.concat(F.upper(F.left(label, F.lit(1))), F.lower(F.substring(label, 2, 2**31 - 1)))


def percent_text(value: Column) -> Column:
    """``12.5`` as ``12.50%``; an exact half goes to the even digit, as in Python's ``.2f``."""
    return F.concat(F.format_number(value, 2), F.lit("%"))
