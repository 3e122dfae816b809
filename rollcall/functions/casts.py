"""Typed reads of string fields that never abort a job.

A pattern guards every cast: a failed cast costs an exception per row, and blank or
odd text is common in these fields.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import strip
from rollcall.schema import DATE_FORMATS, UNKNOWN_AGE, UPLOAD_DATE


def _integer(text: Column, kind: str) -> Column:
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(kind))


def to_key(c: Column) -> Column:
    """Integer key, null when the text is no integer."""
    return _integer(strip(c), "bigint")


def to_age(c: Column) -> Column:
    """Blank means unknown and counts as adult; unreadable text gives null."""
    t = strip(c)
    return F.when(F.coalesce(t, F.lit("")) == "", UNKNOWN_AGE).otherwise(_integer(t, "int"))


def to_number_or_zero(c: Column) -> Column:
    return F.coalesce(to_key(c), F.lit(0).cast("bigint"))


def to_seconds(c: Column) -> Column:
    """Seconds since 1970 of ``yyyy-MM-dd HH:mm:ss`` text, null for anything else.

    Read as UTC whatever the session's zone, so that no hour is skipped or met twice.
    """
    t = strip(c)
    instant = F.concat(t, F.lit("Z")).try_cast("timestamp")
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), F.unix_seconds(instant))


def to_day(c: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """First format that fits; null for blank or unreadable text."""
    t = strip(c)
    shape = lambda f: "^" + re.sub("[yMd]", "[0-9]", f) + "$"
    return F.coalesce(*[F.when(t.rlike(shape(f)), F.try_to_date(t, f)) for f in formats])


def day_text(c: Column, fmt: str = UPLOAD_DATE) -> Column:
    return F.coalesce(F.date_format(c, fmt), F.lit(""))
