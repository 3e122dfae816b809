"""A table kept in key ranges on disk, of which an import or a deletion rewrites only the ranges it touches.

``path/rows`` holds the rows in folders ``bucket=0``, ``bucket=1``, ... by key range, ``path/bounds`` the lower ends. A payload's
keys name the buckets they fall into (a binary search in the stage that reads them); these buckets alone are read, merged and
put in the place of their old files. The number of buckets is bounded by ``MOST_BOUNDS``, so that naming the touched ones on the
driver is, too.

Cases: keys that are no integer share bucket -1. Of an empty payload nothing is touched. A key beyond the last bound belongs to the last bucket; when
many have been added there, the table is created anew. A hot bucket (one id with very many repeat rows) is written by
several tasks. A run that fails before its commit leaves the old files; one that is repeated gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.casts import to_key
from rollcall.operators import upsert
from rollcall.operators.numbering import MOST_BOUNDS, place_in
from rollcall.schema import KEY
from rollcall.session import cut

BUCKET = "bucket"
#: Bucket of keys that are no integer.
UNREADABLE = -1
#: Rows per bucket that the bounds are planned for.
ROWS = 1_000_000


def _key(key: str) -> Column:
    return to_key(F.col(key).cast("string"))


def _bucket(key: str, bounds: list[int]) -> Column:
    return F.coalesce(place_in(_key(key), bounds), F.lit(UNREADABLE)).cast("int")


def _write(rows: DataFrame, path: str) -> None:
    # AQE cuts large buckets into several tasks and lets small ones share one
    writer = rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(f"{path}/rows")


def create(table: DataFrame, path: str, key: str = KEY, rows_per_bucket: int = ROWS) -> None:
    """Store a table in buckets of about equal size, planned by a quantile summary of its keys."""
    spark = table.sparkSession
    keys = table.select(_key(key).alias("k")).filter("k IS NOT NULL")
    n = min(keys.count() // max(1, rows_per_bucket), MOST_BOUNDS)
    cuts: list[int] = []
    if n > 1:
        at = [k / n for k in range(1, n)]
        cuts = sorted(set(keys.agg(F.percentile_approx("k", at, 100 * n).alias("q")).first()["q"]))
    spark.createDataFrame([(c,) for c in cuts], "lo bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")
    _write(table.withColumn(BUCKET, _bucket(key, cuts)), path)


def bounds(spark: SparkSession, path: str) -> list[int]:
    return sorted(r.lo for r in spark.read.parquet(f"{path}/bounds").collect())


def read(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The whole table, or the rows of some buckets; other folders are not listed among the scan's files."""
    rows = spark.read.parquet(f"{path}/rows")
    return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET)


def touched(keys: DataFrame, ends: list[int], key: str = KEY) -> list[int]:
    """Numbers of the buckets that the keys fall into."""
    return sorted(r[0] for r in keys.select(_bucket(key, ends)).distinct().collect())


def _replace(spark: SparkSession, path: str, rows: DataFrame, ends: list[int], named: list[int], key: str) -> None:
    """Put ``rows`` in the place of the buckets ``named``; a bucket that has none left loses its files."""
    # stored first: the merge reads the folders that it replaces
    stored = cut(rows.withColumn(BUCKET, _bucket(key, ends)))
    filled = {r[0] for r in stored.select(BUCKET).distinct().collect()}
    _write(stored, path)
    for number in set(named) - filled:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows/{BUCKET}={number}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def merge(spark: SparkSession, path: str, payload: DataFrame, keys: list[str] | None = None, fill: bool = False) -> list[int]:
    """Import a payload (see ``upsert.upsert``); returns the buckets that were rewritten. The first of ``keys`` is the table's key."""
    keys = keys or [KEY]
    ends = bounds(spark, path)
    payload = cut(payload)
    named = touched(payload, ends, keys[0])
    if named:
        merged = upsert.upsert(read(spark, path, named), payload, keys, fill)
        _replace(spark, path, merged, ends, named, keys[0])
    return named


def delete(spark: SparkSession, path: str, ids: DataFrame, key: str = KEY) -> list[int]:
    """Take the listed keys out; returns the buckets that were rewritten."""
    ends = bounds(spark, path)
    ids = cut(ids.select(_key(key).alias(key)).filter(F.col(key).isNotNull()))
    named = touched(ids, ends, key)
    if named:
        _replace(spark, path, upsert.delete_keys(read(spark, path, named), ids, key), ends, named, key)
    return named
