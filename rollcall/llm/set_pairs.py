"""Pairs of stored sets tested on the whole sets, whatever the number of pairs of one set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import cut, parts_of, shuffle_parts, snug, stored, tidy
from rollcall.operators.lookup import attach

#: Pairs that one copy of a set serves.
FAN = 512
#: Up to this many pairs (two longs each) are broadcast to the stored sets.
BROADCAST_PAIRS = 100_000


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) with 100 * intersection >= percent * union of their whole sets, as stored edges (u, v)."""
    pairs, n = stored(pairs)
    pairs = pairs.coalesce(parts_of(n))
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).groupBy("cid").agg(F.count("*").alias("deg"))
    for end in "ab":
        pairs = attach(pairs, ends.select(F.col("cid").alias(end), F.col("deg").alias(f"deg_{end}")), [end])
    hub = F.expr("deg_a > deg_b OR deg_a = deg_b AND a < b")
    turned = pairs.select(
        F.when(hub, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(hub, F.col("b")).otherwise(F.col("a")).alias("cid"), F.greatest("deg_a", "deg_b").alias("deg")
    )
    turned = cut(turned.select("hub", "cid", F.pmod(F.xxhash64("cid"), F.ceil(F.col("deg") / FAN)).alias("salt")).coalesce(parts_of(n)))
    hubs = turned.select("hub", "salt", F.col("hub").alias("cid")).distinct()
    both = turned.withColumn("spoke", F.lit(True)).union(hubs.select("hub", "cid", "salt", F.lit(False)))
    if n <= BROADCAST_PAIRS:  # then the sets stay where they are stored
        met = sets.join(F.broadcast(both), "cid")
    else:
        met = attach(both, sets, ["cid"], "inner")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.empty(0, np.uint64)
        for b in batches:
            u, v = [], []
            for hub_, salt, cid, spoke, tokens in zip(
                *[b.column(c).to_pylist() for c in ("hub", "salt", "cid", "spoke")], b.column("tokens"), strict=True
            ):
                have = np.frombuffer(tokens.as_buffer(), np.uint64)
                if not spoke:
                    at, own = (hub_, salt), have.copy()
                    continue
                if at != (hub_, salt):
                    raise ValueError(f"set {hub_} is not stored")
                if _linked(own, have, percent):
                    u.append(hub_)
                    v.append(cid)
            yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    order = ["hub", "salt", "spoke", "cid"]
    laid = met.select(*order, "tokens").repartition(shuffle_parts(pairs.sparkSession), "hub", "salt").sortWithinPartitions(*order)
    return snug(laid.mapInArrow(tidy(test), "u long, v long"))


def joined_lists(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored edges (u, v) that join the members of ``lists`` (a, b: pairs of sets, a few hundred sets a row) as all links among its pairs do.

    The sets of a row's members come to it, each once; a pair whose ends are joined already in its row is not tested.
    """
    rows = cut(lists.withColumn("row", F.monotonically_increasing_id()))
    ends = rows.select("row", F.explode(F.array_distinct(F.concat("a", "b"))).alias("cid"))
    few = ends.count() <= BROADCAST_PAIRS  # then the sets stay where they are stored
    met = sets.join(F.broadcast(ends), "cid") if few else attach(ends, sets, ["cid"], "inner")
    none = F.lit(None)
    given = rows.select("row", none.cast("long").alias("cid"), none.cast("binary").alias("tokens"), "a", "b")
    both = met.select("row", "cid", "tokens", none.cast("array<long>").alias("a"), none.cast("array<long>").alias("b")).unionByName(given)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            u, v = [], []
            for cid, tokens, one, two in zip(b.column("cid").to_pylist(), b.column("tokens"), b.column("a"), b.column("b"), strict=True):
                if cid is not None:
                    held[cid] = np.frombuffer(tokens.as_buffer(), np.uint64).copy()
                    continue
                root = {c: c for c in held}

                def find(x: int, root: dict[int, int] = root) -> int:
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                for x, y in zip(one.as_py(), two.as_py(), strict=True):
                    if (p := find(x)) != (q := find(y)) and _linked(held[x], held[y], percent):
                        root[p] = q
                        u.append(x)
                        v.append(y)
                held = {}
            yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    # a row's sets come first, its pairs last
    laid = both.repartition(shuffle_parts(lists.sparkSession), "row").sortWithinPartitions("row", F.col("cid").asc_nulls_last())
    return snug(laid.select("cid", "tokens", "a", "b").mapInArrow(tidy(test), "u long, v long"))
