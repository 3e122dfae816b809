"""Provider names: free text to (first, last)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.schema import HONORIFICS, SUFFIXES


def name_tokens(c: Column) -> Column:
    """Parts between commas, dots and white space."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)[,\s.]+"), lambda t: t != "")


def first_last(tokens: Column) -> Column:
    """struct(first, last); both blank when the shape is not known.

    A leading title wins over a trailing degree. With a title or a degree the name
    proper is what remains: one token is a last name, two are first and last, three
    hold a middle name that is skipped.
    """
    n = F.size(tokens)
    at = lambda i: F.get(tokens, F.lit(i))
    titled = F.lower(at(0)).isin(HONORIFICS)
    degreed = F.lower(F.get(tokens, n - 1)).isin(SUFFIXES)
    skip = F.when(titled, 1).otherwise(0)
    proper = n - F.when(titled | degreed, 1).otherwise(0)
    start = lambda k: F.get(tokens, skip + k)
    alone = (proper == 1) & (titled | degreed)
    known = alone | proper.isin(2, 3)
    first = F.when(proper.isin(2, 3), start(0)).otherwise("")
    last = F.when(alone, start(0)).when(proper == 2, start(1)).when(proper == 3, start(2))
    return F.struct(
        F.when(known, first).otherwise("").alias("first"),
        F.coalesce(F.when(known, last), F.lit("")).alias("last"),
    )
