"""Joining rows to facts that are unique per key, in a form a hot key cannot block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, facts: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Rows with the columns of the one matching fact; ``on`` exists on both sides.

    Spark splits a hot partition only when *both* sides arrive straight from a shuffle made
    for the join. Facts that were just aggregated by the same columns would skip that
    shuffle and leave every row of a hot key to one task. Joining on a struct of the key
    gives the facts, one narrow row per key, a shuffle of their own, so the row side can be
    split however many rows share a key; the wide side is still shuffled once.
    Key fields must not be null. Small facts are broadcast by Spark on their measured size.
    """
    key = F.struct(*[F.col(c) for c in on]).alias("_on")
    left = rows.select(key, *[c for c in rows.columns if c not in on])
    right = facts.select(key, *[c for c in facts.columns if c not in on])
    joined = left.join(right, "_on", how)
    return joined.select(*[F.col(f"_on.`{c}`").alias(c) for c in on], *[c for c in joined.columns if c != "_on"])
