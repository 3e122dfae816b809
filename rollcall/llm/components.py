"""Connected components by alternating large and small stars; nothing but a yes or no reaches the driver.

Each round is a written table, not a checkpoint: a checkpoint keeps the size that its plan was estimated to have, and estimates of joins
of joins are products, whose digits double with every round until they fill the driver. A file has the size it has.

What a round makes has no more rows than edges and nodes together, so every part of it is shuffled and written by as many tasks as the edges need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import discard, new_path, parts_of
from rollcall.operators.lookup import attach


def _settled(now: DataFrame, parts: int) -> bool:
    """Whether every u has one v and no v is a u: then no two stars are connected."""
    twice = now.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
    inner = now.select("u").join(now.select(F.col("v").alias("u")), "u", "left_semi")
    return twice.union(inner).coalesce(parts).isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v; longs) as (u, v): each node that is not its component's smallest, with the smallest. Stored."""
    spark = edges.sparkSession

    parts = parts_of(edges.count())

    def keep(rows: DataFrame) -> tuple[DataFrame, str]:
        path = new_path(spark, "stars")
        rows.distinct().coalesce(parts).write.parquet(path)
        return spark.read.parquet(path), path

    now, path = keep(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while not _settled(now, parts):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).coalesce(parts)
        large = attach(both, least, ["u"], "inner").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.filter("u <> m").select("u", F.col("m").alias("v"))
        ).coalesce(parts)
        root = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
        small = attach(large, root, ["u"], "inner").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = path
        now, path = keep(small.union(root.select("u", F.col("m").alias("v"))).coalesce(parts))
        discard(spark, before)
    return now
