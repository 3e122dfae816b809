"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space around a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every kind of white space, not blanks alone.

    Trimming by character set goes through it for every character; a text that begins and ends with a visible ASCII character, once its
    blanks are off, has nothing left to trim.
    """
    bare = F.trim(c)
    inked = lambda at: F.substring(bare, at, 1).between("!", "~")
    return F.when(inked(1) & inked(-1), bare).otherwise(F.trim(c, F.lit(WHITESPACE)))


def clean(c: Column) -> Column:
    """Trimmed lower case; null stays null."""
    return F.lower(strip(c))


def blank_missing(c: Column) -> Column:
    """Null and the text ``nan`` become the empty string, the only missing value inside. Only a text that holds these letters is trimmed."""
    return F.when(c.isNull() | (F.lower(c).contains("nan") & (F.lower(strip(c)) == "nan")), "").otherwise(c)


def key_text(c: Column) -> Column:
    """Comparable form of an identity field: trimmed, lower case, blank when missing."""
    return F.coalesce(F.nullif(clean(c), F.lit("nan")), F.lit(""))


def has_letter(c: Column) -> Column:
    """True when the value holds a letter that has an upper and a lower form."""
    return F.upper(c) != F.lower(c)


def all_filled(*cs: Column) -> Column:
    """None of the values is blank."""
    test = cs[0] != ""
    for c in cs[1:]:
        test = test & (c != "")
    return test
