"""Exact duplicates: binary-fuse filters over immutable snapshots, exact buckets for what they let through.

Rows come in generations; all but the newest of them are immutable snapshots. Each snapshot gets static filters of its
distinct digests, one per shard. The digests of every later generation are screened against the filters before it; only
positives are looked up in the exact buckets (digests by generation). Repeats inside one generation are found by its own
counts. Rows whose digest survived either way are suspects: their whole texts are grouped, so that equal digests of
different bytes part. All other rows never meet a shuffle with their text.

Cases: a null text counts as empty, so all empty texts are copies. A null id is smaller than any other. Of rows equal in
id and text, one stays. Rows with a null generation belong to the first. An empty table gives an empty result. All
columns of the input are kept; helper columns take names that the input does not have.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm import fuse, screen
from rollcall.llm.common import cut, free_name, snug
from rollcall.operators.lookup import attach


def digest(text_col: str) -> Column:
    """SHA-256 of the text in UTF-8, as bytes."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))


def key_of(digest_col: Column) -> Column:
    return F.xxhash64(digest_col)


def ask_snapshots(entries: DataFrame, filters: DataFrame) -> DataFrame:
    """Keys and digests of ``entries`` that a filter of an earlier generation may hold."""

    def ask(incoming: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(incoming), bool)
        keys, at = incoming["key"].to_numpy().view(np.uint64), incoming["generation"].to_numpy()
        for f in held.itertuples():
            later = np.flatnonzero((at > f.generation) & ~hit)
            hit[later] = fuse.might_hold(keys[later], f.seed, f.length, f.begins, f.table)
        return incoming.loc[hit, ["digest", "generation"]]

    return (
        entries.select("digest", "key", "generation", "shard")
        .groupBy("shard")
        .cogroup(filters.groupBy("shard"))
        .applyInPandas(ask, "digest binary, generation int")
    )


def suspects(docs: DataFrame, text_col: str, generation: Column, shard_keys: int = screen.SHARD_KEYS) -> DataFrame:
    """Digests that occur in more than one row, each once, with ``key``; stored."""
    entries = snug(
        docs.select(digest(text_col).alias("digest"), F.coalesce(generation.cast("int"), F.lit(0)).alias("generation"))
        .groupBy("digest", "generation")
        .agg(F.count("*").alias("size"))
        .withColumn("key", key_of(F.col("digest")))
    )
    facts = entries.agg(F.count("*").alias("n"), F.max("generation").alias("newest")).first()
    shards = max(1, -(-facts["n"] // shard_keys))
    entries = entries.withColumn("shard", F.pmod(F.col("key"), F.lit(shards)).cast("int"))
    inside = entries.filter(F.col("size") > 1).select("digest")
    snapshots = entries.filter(F.col("generation") < F.lit(facts["newest"]))
    positives = ask_snapshots(entries, screen.filters(snapshots, ["generation", "shard"])).select("digest", F.col("generation").alias("_later"))
    across = (
        positives.join(snapshots.select("digest", "generation"), "digest")
        .filter(F.col("generation") < F.col("_later"))
        .select("digest")
    )
    return snug(inside.union(across).distinct().withColumn("key", key_of(F.col("digest"))))


def mark(
    docs: DataFrame,
    generation: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_bytes: int = screen.BROADCAST_BYTES,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` in a struct column ``dedup``.

    ``with_text=False`` returns the id and the struct only. If the input has a column ``dedup``, the struct gets a longer
    name, the last of the result.
    """
    col = {x: free_name(docs.columns, f"_{x}") for x in ("digest", "suspect", "tag", "top", "size", "n")}
    out = free_name(docs.columns, "dedup")
    found = suspects(docs, text_col, generation)
    hashed = docs.withColumn(col["digest"], digest(text_col))
    flagged = screen.flag(hashed, found, key_of(F.col(col["digest"])), col["suspect"], broadcast_bytes)
    kept_cols = docs.columns if with_text else [id_col]

    def struct(keep: Column, size: Column, kept: Column) -> Column:
        return F.struct(
            keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), F.lower(F.hex(col["digest"])).alias("text_sha256")
        ).alias(out)

    single = flagged.filter(~F.col(col["suspect"])).select(*kept_cols, struct(F.col(id_col), F.lit(1).cast("long"), F.lit(True)))
    rows = cut(
        flagged.filter(col["suspect"]).drop(col["suspect"]).withColumn(col["tag"], F.monotonically_increasing_id())
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    groups = cut(
        rows.groupBy(F.col(col["digest"]), text.alias("_bytes"))
        .agg(F.max(F.struct(F.col(id_col).alias("id"), F.col(col["tag"]).alias("tag"))).alias(col["top"]), F.count("*").alias(col["size"]))
    )
    facts = groups.groupBy(col["digest"]).agg(
        F.first(col["top"]).alias(col["top"]), F.first(col["size"]).alias(col["size"]), F.count("*").alias(col["n"])
    )
    top = F.col(col["top"])
    judged = struct(top["id"], F.col(col["size"]), top["tag"] == F.col(col["tag"]))
    # a digest that a third of all rows have can be split in this join
    again = attach(rows, facts.filter(F.col(col["n"]) == 1), [col["digest"]], "inner").select(*kept_cols, judged)
    if not facts.filter(F.col(col["n"]) > 1).isEmpty():  # equal digests, different bytes
        parted = groups.join(facts.filter(F.col(col["n"]) > 1).select(col["digest"]), col["digest"], "left_semi")
        more = rows.withColumn("_bytes", text).join(parted, [col["digest"], "_bytes"]).select(*kept_cols, judged)
        again = again.unionByName(more)
    return single.unionByName(again)


def by_range(docs: DataFrame, generations: int, id_col: str = "doc_id") -> Column:
    """Generation of a row: equal ranges of integer ids in ascending order, the newest last; null is the first."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    if low is None:
        return F.lit(0)
    width = (high - low) // generations + 1
    return F.floor((F.col(id_col) - F.lit(low)) / F.lit(width)).cast(T.IntegerType())


def keep_one(docs: DataFrame, generation: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: the row with the largest id stays."""
    marked = mark(docs, generation, id_col, text_col)
    return marked.filter(F.col(marked.columns[-1])["kept"]).select(*docs.columns)
