"""Snapshots to comparable frames: cleaning, collapsing, typing, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.casts import to_age, to_key, to_number_or_zero, to_seconds
from rollcall.functions.text import all_filled, blank_missing, has_letter, key_text
from rollcall.operators.lookup import attach
from rollcall.schema import (
    ADULT_AGE,
    FOREIGN,
    FOREIGN_CHILD,
    INSTANCE,
    INSTRUMENT,
    KEY,
    LAB,
    OWN_CHILD,
    RECORD,
    REGISTRY_MATCH_FIELDS,
    SOURCE_MATCH_FIELDS,
    UPDATED,
)
from rollcall.session import cut

# --- projections ---------------------------------------------------------------


def normalize_text(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Trim and lower every string column (but ``keep``), missing becomes blank."""
    keep = keep or []
    return df.select(
        *[
            key_text(F.col(f.name)).alias(f.name)
            if f.dataType.simpleString() == "string" and f.name not in keep
            else F.col(f.name)
            for f in df.schema
        ]
    )


def blank_nulls(df: DataFrame) -> DataFrame:
    """Null and ``nan`` text become blank in every string column, the rest of the text stays."""
    return df.select(
        *[
            blank_missing(F.col(f.name)).alias(f.name)
            if f.dataType.simpleString() == "string"
            else F.col(f.name)
            for f in df.schema
        ]
    )


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop what exists; names gone from the snapshot show up in the drift report instead."""
    return df.drop(*names)


def keep_columns(df: DataFrame, allowed: list[str]) -> DataFrame:
    known = set(allowed)
    return df.select(*[c for c in df.columns if c in known])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def add_constants(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


# --- row filters -----------------------------------------------------------------


def complete(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows in which none of the named fields is blank."""
    return df.filter(all_filled(*[F.coalesce(F.col(n), F.lit("")) for n in names]))


def is_base() -> Column:
    return F.coalesce(F.col(INSTRUMENT), F.lit("")) == ""


def base_rows(df: DataFrame) -> DataFrame:
    """Base rows of a table with repeats; all rows of a table that has none."""
    return df.filter(is_base()) if INSTRUMENT in df.columns else df


def adults(df: DataFrame) -> DataFrame:
    return df.filter(F.col("age") >= ADULT_AGE)


def children(df: DataFrame) -> DataFrame:
    return df.filter(F.col("age") < ADULT_AGE)


def differing(df: DataFrame, a: str, b: str) -> DataFrame:
    """Both present and not equal."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))


def any_code(df: DataFrame, code: str, names: list[str]) -> Column:
    """True when one of the columns holds the code; null counts as blank."""
    return F.lit(code).isin(*[F.coalesce(df[n], F.lit("")) for n in names])


# --- collapse ----------------------------------------------------------------------


def first_rows(df: DataFrame, names: list[str], key: str = RECORD) -> DataFrame:
    """The first row of each key, with ``_whole``: a base row without nulls. Such rows come first, then the order of ``_ranked``.

    Spark keeps one row per key and input split before the shuffle (a limit on the group's rank), so a record with very
    many repeats costs next to nothing.
    """
    values = [n for n in names if n != key]
    order = Window.partitionBy(key).orderBy(~F.col("_whole"), "_place", *values)
    ranked = _ranked(df, values, key).withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").select(key, *values, "_whole")


def _fields(df: DataFrame, names: list[str], key: str) -> DataFrame:
    """What ``_ranked`` reads."""
    return df.select(*dict.fromkeys([key, *names, INSTRUMENT, INSTANCE]))


def whole_rows(df: DataFrame, names: list[str], key: str = RECORD) -> tuple[DataFrame, DataFrame]:
    """Per key its first base row without nulls (see ``first_rows``), and the keys that have none. From stored rows.

    Such rows are counted per key, a hash aggregate of the key alone, with the keys of repeat rows as none. The row of a key that has
    one is taken as it was read, with neither sort nor shuffle; only if some keys have several are rows joined to these keys, and
    theirs ranked.
    """
    values = [n for n in names if n != key]
    base = cut(_fields(df.filter(is_base()), names, key))
    ranked = lambda rows: _ranked(rows, values, key)
    whole = lambda rows: ranked(rows).filter("_whole").select(key, *values)
    marks = ranked(base).select(key, F.col("_whole").cast("int").alias("_n"))
    marks = marks.unionByName(df.filter(~is_base()).select(key, F.lit(0).alias("_n")))
    counts = cut(marks.groupBy(key).agg(F.sum("_n").alias("_n")))
    open_ = counts.filter("_n = 0").select(key)
    several = counts.filter("_n > 1").select(key, F.lit(True).alias("_several"))
    if several.isEmpty():
        return whole(base), open_
    rows = cut(attach(base, several, [key]))
    first = first_rows(rows.filter("_several"), names, key).select(key, *values)
    return whole(rows.filter("_several IS NULL")).unionByName(first), open_


def _ranked(df: DataFrame, values: list[str], key: str) -> DataFrame:
    """Key and values with ``_whole`` and ``_place``: base row, then repeats by instrument and instance."""
    number = to_number_or_zero(F.col(INSTANCE).cast("string"))
    on_base = is_base() & (number == 0)
    place = F.when(on_base, "").otherwise(
        F.concat(F.coalesce(F.col(INSTRUMENT), F.lit("")), F.lit("\u0001"), F.lpad(number.cast("string"), 20, "0"))
    )
    whole = on_base
    for n in values:
        whole = whole & F.col(n).isNotNull()
    return df.select(key, *values, whole.alias("_whole"), place.alias("_place"))


def first_values(df: DataFrame, names: list[str], key: str = RECORD) -> DataFrame:
    """First non-null value of each column by place, then by value: one rank per key and column, so one row of each crosses the shuffle."""
    values = [n for n in names if n != key]
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("text")) for n in values])
    long = _ranked(df, values, key).select(key, "_place", F.inline(cells)).filter("text IS NOT NULL")
    order = Window.partitionBy(key, "name").orderBy("_place", "text")
    found = long.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
    # one entry per column at most
    held = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("name", "text"))).alias("_held"))
    kinds = dict(df.dtypes)
    return held.select(key, *[F.col("_held")[n].cast(kinds[n]).alias(n) for n in values])


def collapse(df: DataFrame, names: list[str], key: str = RECORD) -> DataFrame:
    """One row per key with the first non-null value of each column. Stored.

    Order is explicit: the base row, then repeats by instrument and instance, then the values themselves, so the answer never
    follows row order. A blank is a value and wins over a later filled one.

    Nearly every record has a base row without nulls, and then that row is the answer (``whole_rows``). Only the keys
    left over go through their rows again, column by column (``first_values``); a key whose values are all null keeps its row.
    """
    values = [n for n in names if n != key]
    first, open_ = whole_rows(df, names, key)
    if open_.isEmpty():
        return first
    rows = cut(attach(_fields(df, names, key), open_, [key], "inner"))  # so that ranking does not share a task with what made the rows
    held = first_values(rows, names, key)
    return first.unionByName(open_.join(held, key, "left").select(key, *values))


# --- the two sides of the match --------------------------------------------------------


def index_registry(snapshot: DataFrame, names: list[str] = REGISTRY_MATCH_FIELDS) -> DataFrame:
    """Registry fields used for matching, cleaned, with an integer key."""
    cleaned = normalize_text(snapshot.select(*names), keep=[KEY])
    typed = cleaned.withColumn(KEY, to_key(F.col(KEY).cast("string")))
    return typed.filter(F.col(KEY).isNotNull())


def index_source(snapshot: DataFrame) -> DataFrame:
    """One cleaned row per source record with integer age and update time in seconds."""
    rows = snapshot.withColumn(RECORD, key_text(F.col(RECORD))).filter(F.col(RECORD) != "")
    one = collapse(rows, SOURCE_MATCH_FIELDS)
    typed = normalize_text(one, keep=[RECORD, "age", UPDATED]).select(
        RECORD,
        *FOREIGN,
        *FOREIGN_CHILD,
        LAB,
        to_age(F.col("age")).alias("age"),
        to_seconds(F.col(UPDATED)).alias("updated"),
    )
    return typed.filter(F.col("age").isNotNull())


def registry_quarantine(snapshot: DataFrame) -> DataFrame:
    """Registry rows whose key is no integer."""
    bad = to_key(F.col(KEY).cast("string")).isNull()
    return snapshot.filter(bad).select(F.col(KEY), F.lit("bad_key").alias("reason"))


def source_quarantine(snapshot: DataFrame) -> DataFrame:
    """Source records left out of the match: no record id, or an unreadable age."""
    one = collapse(snapshot.withColumn(RECORD, key_text(F.col(RECORD))), [RECORD, "age"])
    reason = F.when(F.col(RECORD) == "", "blank_id").when(to_age(F.col("age")).isNull(), "bad_age")
    return one.select(RECORD, "age", reason.alias("reason")).filter(F.col("reason").isNotNull())


def named_child() -> Column:
    return has_letter(F.col(OWN_CHILD[1]))
