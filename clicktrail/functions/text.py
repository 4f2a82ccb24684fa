"""Column helpers for dirty text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: texts that stand for "no value" in exported hit files.
NULL_TEXTS = ("", "nan", "None")


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """NULL, empty or whitespace only.

    A left trim is enough to decide that and stops at the first visible
    character, so long values cost nothing extra.
    """
    return c.isNull() | (F.ltrim(c, F.lit(WHITESPACE)) == "")


def is_missing(c: Column) -> Column:
    return c.isNull() | stripped(c).isin(*NULL_TEXTS)


def without_cr(c: Column) -> Column:
    return F.replace(c, F.lit("\r"), F.lit(""))


def masked(c: Column) -> Column:
    """Short, stable, irreversible stand-in for a personal value."""
    digest = F.substring(F.sha2(stripped(c), 256), 1, 16)
    return F.when(c.isNull() | (c == ""), F.lit("EMPTY")).otherwise(F.concat(digest, F.lit("...")))


def literal_pattern(text: str) -> str:
    """A regex that matches ``text`` and nothing else; one plain character stays
    one, which ``split`` handles without a regex engine."""
    return re.escape(text)
