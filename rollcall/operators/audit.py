"""Checks of a finished mapping, and identity checks for outside requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.lookup import attach
from rollcall.operators.normalize import base_rows, differing
from rollcall.schema import FOREIGN, KEY, LAB, MRN, OWN, RECORD
from rollcall.session import cut


def name_mismatches(source: DataFrame, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """Mapped pairs that agree on registry id and lab id but not on the first name.

    Blank lab ids equal each other here, and a blank name counts as a value.
    """
    mapped = attach(mapping.select(RECORD, KEY), source.select(RECORD, LAB, *FOREIGN), [RECORD], "inner")
    both = mapped.join(base_rows(registry).select(KEY, LAB, *OWN), [KEY, LAB])
    return differing(both, "first_local", "first_name").select(
        RECORD, KEY, LAB, "first_name", "last_name", "first_local", "last_local"
    )


def id_mismatches(mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry ids whose stored record id is not the computed one.

    ``kind``: ``first_link`` when nothing was stored, else ``changed``.
    """
    stored = base_rows(registry).select(KEY, F.col(RECORD).alias("stored_record_id"))
    both = stored.join(mapping.select(KEY, RECORD), KEY)
    kind = F.when(F.col("stored_record_id") == "", "first_link").otherwise("changed")
    return differing(both, "stored_record_id", RECORD).select(KEY, RECORD, "stored_record_id", kind.alias("kind"))


def verified_lookup(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requests (mrn, first_name, last_name, dob) with ids and status.

    ``verified``: one registry row holds the number and its name and birth date agree.
    ``mismatch``: one row, other identity. ``not_one``: no row or several.
    """
    identity = ["first_local", "last_local", "dob"]
    one = (
        base_rows(registry).filter(F.col(MRN) != "")
        .groupBy(MRN)
        .agg(
            F.count("*").alias("_n"),
            *[F.min(n).alias(f"_{n}") for n in identity],
            F.min(KEY).alias("_key"),
            F.min(RECORD).alias("_record"),
        )
        .filter("_n = 1")
    )
    same = (
        (F.col("first_name") == F.col("_first_local"))
        & (F.col("last_name") == F.col("_last_local"))
        & (F.col("dob") == F.col("_dob"))
    )
    status = F.when(F.col("_n").isNull(), "not_one").when(same, "verified").otherwise("mismatch")
    joined = attach(requests, one, [MRN]).withColumn("status", status)
    ok = F.col("status") == "verified"
    return joined.select(
        *requests.columns,
        F.when(ok, F.col("_key")).alias(KEY),
        F.when(ok, F.col("_record")).alias(RECORD),
        "status",
    )


def exactly_one(rows: DataFrame, probe: str, value: str) -> DataFrame:
    """Probes that lead to exactly one distinct value, with that value."""
    return (
        rows.groupBy(probe)
        .agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        .filter("_low = _high")
        .select(probe, F.col("_low").alias(value))
    )


def counted(df: DataFrame, **more: Column) -> tuple[DataFrame, Observation]:
    """``df`` and the number of its rows (``n_rows``), known once the frame has been stored: no pass of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in more.items()]), seen


def stage_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """One row per stage with the number of rows that was observed when the stage was stored."""
    return spark.createDataFrame(list(counts.items()), "stage string, n_rows bigint")


def stored_and_counted(stages: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Each stage stored, and ``stage_counts`` of them; a stage is worked out once."""
    kept, counts = {}, {}
    for name, df in stages.items():
        watched, seen = counted(df)
        kept[name] = cut(watched)
        counts[name] = seen.get["n_rows"]
    spark = next(iter(stages.values())).sparkSession
    return kept, stage_counts(spark, counts)
