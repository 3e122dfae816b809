"""Rows whose 64-bit key may be among given keys, by broadcast binary-fuse filters of checked size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm import fuse

#: Keys of a shard, on average; what one task holds while building.
SHARD_KEYS = 1 << 17
#: Filters up to this size are broadcast; beyond it the rows are joined to the keys.
BROADCAST_BYTES = 64 << 20


def filters(keys: DataFrame, by: list[str]) -> DataFrame:
    """One filter of the column ``key`` for each value of the integer columns ``by``."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        row = (*(pdf[c].iat[0] for c in by), *fuse.build(pdf["key"].to_numpy().view(np.uint64)))
        return pd.DataFrame([row], columns=[*by, "seed", "length", "begins", "table"])

    schema = ", ".join(f"{c} int" for c in by) + ", seed int, length int, begins int, table binary"
    return keys.select(*by, "key").groupBy(*by).applyInPandas(build, schema)


def flag(rows: DataFrame, keys: DataFrame, key: Column, name: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with ``name``: false only where ``key`` is not in the distinct column ``key`` of ``keys``."""
    n = keys.count()
    if n * 9 // 8 * 1.5 > most:
        held = keys.select(F.col("key").alias(f"{name}_key"), F.lit(True).alias(name))
        joined = rows.join(held, key == F.col(f"{name}_key"), "left").drop(f"{name}_key")
        return joined.withColumn(name, F.coalesce(name, F.lit(False)))
    shards = max(1, -(-n // SHARD_KEYS))
    parts = filters(keys.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int")), ["shard"]).collect()
    held = rows.sparkSession.sparkContext.broadcast({r["shard"]: (*tuple(r)[1:4], bytes(r["table"])) for r in parts})

    @F.pandas_udf("boolean")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            raw = s.to_numpy()
            out = np.zeros(len(raw), bool)
            shard = raw % shards
            for k, f in held.value.items():
                own = np.flatnonzero(shard == k)
                out[own] = fuse.might_hold(raw[own].view(np.uint64), *f)
            yield pd.Series(out)

    return rows.withColumn(name, ask(key))
