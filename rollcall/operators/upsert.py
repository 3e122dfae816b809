"""Bringing payloads into a table, and taking keys out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.casts import to_key
from rollcall.schema import KEY


def _merged(name: str, kind: str, payload: set[str], keys: list[str], fill: bool) -> Column:
    old, new = F.col(f"o.{name}"), F.col(f"n.{name}")
    if name in keys:
        return F.coalesce(new, old).alias(name)
    if name not in payload:
        return F.coalesce(old, F.lit("")).alias(name) if kind == "string" else old.alias(name)
    if kind == "string":
        given = F.coalesce(new, F.lit(""))
        taken = F.when(given == "", F.coalesce(old, F.lit(""))).otherwise(given) if fill else given
    else:
        taken = F.coalesce(new, old) if fill else new
    hit = F.col("n._hit").isNotNull()
    return F.when(hit, taken).otherwise(F.coalesce(old, F.lit("")) if kind == "string" else old).alias(name)


def upsert(
    table: DataFrame, payload: DataFrame, keys: list[str] | None = None, fill: bool = False, patch: bool = False
) -> DataFrame:
    """Table after importing the payload, which has one row per key.

    ``fill=False`` overwrites: payload columns replace the table's, blanks included.
    ``fill=True`` only adds: a blank never erases a value. Columns outside the payload
    stay; keys new to the table are appended; a column the table lacks is an error.

    Null and blank text keys are the same key. If the payload repeats a key, its last row counts, in the order of all its
    values.

    A payload the size of the table is merged by one full outer join. ``patch=True`` is
    for payloads much smaller than the table: the table side is left-joined, which lets
    Spark broadcast the payload when its measured size permits and leave the table unshuffled.
    """
    keys = keys or [KEY]
    unknown = [c for c in payload.columns if c not in table.columns]
    if unknown:
        raise ValueError(f"fields not found in the table: {unknown}")
    sent = set(payload.columns)
    kinds = dict(table.dtypes)
    plain = {k: F.coalesce(F.col(k), F.lit("")) for k in keys if kinds[k] == "string"}
    table, payload = table.withColumns(plain), payload.withColumns(plain)
    payload = one_per_key(payload, keys)
    old = table.alias("o")
    new = payload.withColumn("_hit", F.lit(True)).alias("n")
    columns = [_merged(f.name, f.dataType.simpleString(), sent, keys, fill) for f in table.schema]
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    if not patch:
        return old.join(new, same, "full_outer").select(*columns)
    changed = old.join(new, same, "left").select(*columns)
    # the table's keys meet the payload as the left side, so only the payload may be broadcast and the table stays in place
    named = payload.select(*[F.col(k).alias(f"_{k}") for k in keys])
    found = table.select(*keys).join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi").distinct()
    found = found.select(*[F.col(k).alias(f"_{k}") for k in keys])
    fresh = payload.join(found, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
    blanks = [
        F.col(f.name)
        if f.name in keys
        else (
            (F.coalesce(F.col(f.name), F.lit("")) if f.dataType.simpleString() == "string" else F.col(f.name))
            if f.name in sent
            else (F.lit("") if f.dataType.simpleString() == "string" else F.lit(None).cast(f.dataType))
        ).alias(f.name)
        for f in table.schema
    ]
    return changed.unionByName(fresh.select(*blanks))


def one_per_key(payload: DataFrame, keys: list[str], order_by: str | None = None) -> DataFrame:
    """Last row per key in the order of ``order_by``, then of all values, so that the answer never follows row order."""
    rest = [c for c in payload.columns if c not in keys]
    if not rest:
        return payload.distinct()
    order = F.struct(*([F.col(order_by)] if order_by else []), *rest)
    last = F.max_by(F.struct(*rest), order).alias("_last")
    return payload.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*payload.columns)


def _asked(ids: DataFrame, key: str) -> DataFrame:
    """Requested keys as integers, each once; unreadable ones ask for nothing."""
    return ids.select(to_key(F.col(key).cast("string")).alias("_asked")).filter("_asked IS NOT NULL").distinct()


def delete_keys(table: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """Table without the listed keys; rows whose key is no number stay."""
    return table.join(_asked(ids, key), to_key(F.col(key).cast("string")) == F.col("_asked"), "left_anti")


def delete_receipt(table: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """Each requested key once, with the number of rows it removes."""
    asked = _asked(ids, key)
    hits = table.select(to_key(F.col(key).cast("string")).alias("_asked")).join(asked, "_asked", "left_semi")
    counted = hits.groupBy("_asked").agg(F.count("*").alias("n_rows"))
    return asked.join(counted, "_asked", "left").select(F.col("_asked").alias(key), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
