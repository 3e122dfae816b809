"""Running the sync on snapshots that have arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.text import key_text
from rollcall.operators.lookup import attach
from rollcall.operators.normalize import blank_nulls
from rollcall.schema import RECORD, all_strings
from rollcall.sources.snapshots import CORRUPT

SNAPSHOT = "snapshot"


def newest_rows(rows: DataFrame) -> DataFrame:
    """All rows a record has in the latest of the snapshots it occurs in.

    The latest snapshot is one aggregate row per record joined back, so a record with very
    many repeat rows is not gathered.
    """
    keyed = rows.withColumn("_record", key_text(F.col(RECORD)))
    latest = keyed.groupBy("_record").agg(F.max(SNAPSHOT).alias("_latest"))
    return attach(keyed, latest, ["_record"], "inner").filter(F.col(SNAPSHOT) == F.col("_latest")).drop("_record", "_latest", SNAPSHOT)


def sync_arrivals(
    spark: SparkSession,
    folder: str,
    fields: list[str],
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    quarantine: str | None = None,
) -> None:
    """Hand each micro-batch of new files under ``folder/snapshot=<date>/`` to ``handle``.

    Files hold JSON lines. A cut-off line ends the run, or with ``quarantine`` goes to the folder of its batch there
    (snapshot, raw text) and gives no row. The run ends when all files present have been handled. A batch
    repeated after a failure gets the same number, and the sync overwrites, so ``handle``
    writing to a path with that number is safe to repeat.
    """
    names = [*fields, SNAPSHOT] if quarantine is None else [*fields, SNAPSHOT, CORRUPT]
    reader = spark.readStream.schema(all_strings(names)).option("columnNameOfCorruptRecord", CORRUPT)
    stream = reader.option("mode", "FAILFAST" if quarantine is None else "PERMISSIVE").json(folder)

    def each(batch: DataFrame, number: int) -> None:
        if quarantine is not None:
            held = batch.filter(F.col(CORRUPT).isNotNull()).select(SNAPSHOT, F.col(CORRUPT).alias("raw"), fields[0])
            held.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
            batch = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        handle(newest_rows(blank_nulls(batch)), number)

    running = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


def send_arrivals(
    spark: SparkSession, folder: str, fields: list[str], send: Callable[[DataFrame, int], DataFrame], checkpoint: str
) -> None:
    """Alerts for survey states that arrive as files under ``folder/snapshot=<date>/``.

    ``send(surveys, run)`` is ``jobs.send_alerts`` with its other arguments; the number of the micro-batch is the run, so a batch that is
    repeated after a failure replaces its own sends.
    """

    def handle(batch: DataFrame, number: int) -> None:
        send(batch, number)

    sync_arrivals(spark, folder, fields, handle, checkpoint)
