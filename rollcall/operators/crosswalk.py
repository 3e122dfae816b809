"""Medical record number to enterprise id, as one set-based lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.lookup import attach
from rollcall.operators.normalize import base_rows
from rollcall.schema import EMPI, FACILITIES, KEY, MRN


def lookup_table(patient_map: DataFrame) -> DataFrame:
    """Number, least and greatest enterprise id it leads to.

    A number is an enterprise id itself, or a local id of an accepted facility: two plain
    keys put under one another instead of an OR in a join condition.
    """
    itself = patient_map.select(F.col("empi").alias("number"), "empi")
    local = patient_map.filter(F.col("facility_code").isin(FACILITIES)).select(
        F.col("local_pt_id").alias("number"), "empi"
    )
    return (
        itself.unionByName(local)
        .filter((F.col("number") != "") & F.col("empi").isNotNull())
        .groupBy("number")
        .agg(F.min("empi").alias("low"), F.max("empi").alias("high"))
    )


def crosswalk(registry: DataFrame, patient_map: DataFrame) -> DataFrame:
    """(key, mrn, enterprise id, status) for every base row of the registry; null counts as blank.

    Status: ``skip_has_empi``, ``skip_no_mrn``, ``not_found``, ``not_unique`` or ``filled``;
    only ``filled`` carries an id found now.
    """
    base = base_rows(registry).select(KEY, *[F.coalesce(c, F.lit("")).alias(c) for c in (MRN, EMPI)])
    skip = F.when(F.col(EMPI) != "", "skip_has_empi").when(F.col(MRN) == "", "skip_no_mrn")
    rows = base.select(KEY, MRN, EMPI, skip.alias("_skip"))
    alone = F.concat(F.lit("\u0000"), F.col(KEY).cast("string"))
    rows = rows.withColumn("number", F.when(F.col("_skip").isNull(), F.col(MRN)).otherwise(alone))
    found = attach(rows, lookup_table(patient_map), ["number"])
    status = (
        F.when(F.col("_skip").isNotNull(), F.col("_skip"))
        .when(F.col("low").isNull(), "not_found")
        .when(F.col("low") != F.col("high"), "not_unique")
        .otherwise("filled")
    )
    found = found.withColumn("status", status)
    return found.select(
        KEY, MRN, F.when(F.col("status") == "filled", F.col("low")).otherwise(F.col(EMPI)).alias(EMPI), "status"
    )


def filled(walked: DataFrame) -> DataFrame:
    """Payload for a fill-only upsert."""
    return walked.filter(F.col("status") == "filled").select(KEY, EMPI)


def issues(walked: DataFrame) -> DataFrame:
    return walked.filter(F.col("status") != "filled").select(KEY, MRN, "status")
