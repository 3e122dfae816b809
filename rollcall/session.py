"""Session settings and lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on. Sizes (memory, cores, shuffle partitions) stay with the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot names and hot labs are joined to a side that is unique per key, so
    # splitting the hot partition is always possible.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture for every column expression makes building wide plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build(app: str = "rollcall", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for the dot."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder of ``spark.checkpoint.dir``, else one in the warehouse, which executors share as well."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    Used where a frame feeds several branches, or where later steps must see the
    very rows an earlier job counted, whatever executors are lost in between.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
