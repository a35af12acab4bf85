"""Column functions that parse, validate and build keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordbase.schemas import MIRROR_PREFIX, RELATIONS, WORD_PREFIX

_RELATION_STEMS = tuple(name.removesuffix("_OF") for name in RELATIONS)


# Fixed value: the characters a strip takes off
WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)


def stripped(value: Column) -> Column:
    """The text without white space of any kind at either end."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def blank_to_null(value: Column) -> Column:
    return F.nullif(stripped(value), F.lit(""))


# Numbers as text: single underscores may stand between digits
_DIGITS = r"\d+(?:_\d+)*"
_WHOLE = rf"^\s*([+-]?{_DIGITS})\s*$"
_DECIMAL = (
    rf"(?i)^\s*([+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf|infinity|nan))\s*$"
)


def _number(text: Column, pattern: str, kind: str) -> Column:
    # no match extracts "", which is no number either
    return F.translate(F.regexp_extract(text, pattern, 1), "_", "").try_cast(kind)


def safe_count(value: Column, kind: str) -> Column:
    """A whole number, 0 when the text is no whole number; a float is cut towards zero."""
    parsed = _number(value, _WHOLE, "long") if kind == "string" else value.try_cast("long")
    return F.coalesce(parsed, F.lit(0).cast("long"))


def safe_double(value: Column) -> Column:
    """A number, null for blank or bad text."""
    return _number(value, _DECIMAL, "double")


def relation_type(text: Column) -> Column:
    """Stored relation name for either spelling (``synonym``, ``SYNONYM_OF``); null if unknown."""
    name = F.regexp_replace(F.upper(stripped(text)), "_OF$", "")
    return F.when(name.isin(*_RELATION_STEMS), F.concat(name, F.lit("_OF")))


def relation_name(text: str) -> str:
    """The same for one argument; an unknown relation raises."""
    name = text.strip().upper().removesuffix("_OF") + "_OF"
    if name not in RELATIONS:
        raise ValueError(f"unknown relation {text!r}, expected one of {', '.join(RELATIONS)}")
    return name


def word_key(word: Column) -> Column:
    return F.concat(F.lit(WORD_PREFIX), word)


def mirror_key(word: Column) -> Column:
    return F.concat(F.lit(MIRROR_PREFIX), word)


def mirror_word(key: Column) -> Column:
    """The word of a mirror key; null for keys of other kinds."""
    return F.when(
        key.startswith(MIRROR_PREFIX), F.substring(key, len(MIRROR_PREFIX) + 1, 2**31 - 1)
    )


_GLOB_PART = re.compile(r"\\(?P<quoted>.)|(?P<set>\[[^\]]*\])|(?P<any>\*)|(?P<one>\?)|(?P<plain>.)", re.S)


def _regex_part(match: re.Match) -> str:
    kind, text = match.lastgroup, match.group(match.lastgroup)
    if kind == "any":
        return ".*"
    if kind == "one":
        return "."
    if kind == "set":
        return re.sub(r"(?<!^)\[|&", r"\\\g<0>", text)
    return re.sub(r"([^A-Za-z0-9_\s])", r"\\\1", text)


def key_matches(key: Column, pattern: str = "*") -> Column:
    """Glob match on keys: ``*`` any run, ``?`` one character, ``[...]`` a set, ``\\`` quotes.

    The literal start of the pattern is tested on its own as well, because a plain
    prefix test reaches the file scan and a regular expression does not.
    """
    start = re.match(r"[^\\\[*?]*", pattern).group()
    matched = key.rlike("(?s)^" + _GLOB_PART.sub(_regex_part, pattern) + r"\z")
    return key.startswith(start) & matched if start else matched
