"""Text columns: trimming, paragraph arrays, label cleaning."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# --- Fixed values -----------------------------------------------------------
# Characters that count as white space at both ends of a paragraph.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Boilerplate phrases; a paragraph that holds one is not content.
BOILERPLATE = ("acceso a esta página",)
# Column-name rules, applied in this order: (regular expression, replacement).
NAME_RULES = (
    ("cat__", ""),
    ("num__", ""),
    (" ", "_"),
    ("_Yes", ""),
    ("_1", ""),
    ("[()]", ""),
    ("-", "_"),
    ("[^0-9a-zA-Z_]+", ""),
    ("_+", "_"),
)
# ----------------------------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row. A plain column name would
    not do inside a lambda: the optimizer may put the whole expression in its
    place, where it is computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stripped(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def literal_pattern(text: str) -> str:
    """A regular expression that matches ``text`` itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def paragraphs(text: Column, sep: str = "\n\n") -> Column:
    """Array of the non-empty, trimmed pieces of ``text``."""
    pieces = F.transform(F.split(text, literal_pattern(sep), -1), stripped)
    return F.filter(pieces, lambda piece: piece != "")


def content_only(pieces: Column, min_chars: int = 50,
                 phrases: Sequence[str] = BOILERPLATE) -> Column:
    """Keep pieces that are long enough and free of boilerplate (case-insensitive)."""

    def is_content(piece: Column) -> Column:
        keep = F.length(piece) >= min_chars
        for phrase in phrases:
            keep = keep & ~F.contains(F.lower(piece), F.lit(phrase.lower()))
        return keep

    return F.filter(pieces, is_content)


def clean_name(name: str) -> str:
    """A column name that every table format accepts."""
    return reduce(lambda text, rule: re.sub(rule[0], rule[1], text), NAME_RULES, name.strip())


def clean_label(col: Column) -> Column:
    """``clean_name`` over a column of labels."""
    return reduce(lambda text, rule: F.regexp_replace(text, rule[0], rule[1]),
                  NAME_RULES, stripped(col))


def compact_text(col: Column, limit: int = 64) -> Column:
    """Stand-in for grouping and counting long texts: the text itself below
    ``limit`` characters, else its SHA-256. The two cannot meet, since a digest
    has 64 characters, and a shuffle then moves 64 bytes instead of a document."""
    return F.when(F.length(col) < limit, col).otherwise(F.sha2(col, 256))
