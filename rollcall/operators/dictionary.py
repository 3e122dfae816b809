"""Data dictionaries: merging, exporting, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.lookup import attach
from rollcall.operators.numbering import number_rows
from rollcall.schema import CALC_TAG, RECORD


def merge(registry: DataFrame, source: DataFrame, from_source: list[str] | None = None) -> DataFrame:
    """Registry fields, then source fields the registry lacks, with ``position`` from 1.

    Forms listed in ``from_source`` are taken from the source entirely. Forms come in the
    order they first appear and stay together; fields keep their order inside. The order of
    a form is one aggregate row joined back, so a form with very many fields splits.
    """
    kept = registry.filter(~F.col("form_name").isin(from_source)) if from_source else registry
    added = source.join(kept.select("field_name"), "field_name", "left_anti")
    fields = kept.withColumn("origin", F.lit("registry")).unionByName(
        added.withColumn("origin", F.lit("source")), allowMissingColumns=True
    )
    side = F.when(F.col("origin") == "registry", 0).otherwise(1)
    fields = fields.withColumn("_side", side)
    forms = fields.groupBy("form_name").agg(F.min(F.struct("_side", "seq")).alias("_form"))
    placed = attach(fields, forms, ["form_name"], "inner").withColumns(
        {"_form_side": F.col("_form._side"), "_form_seq": F.col("_form.seq")}
    )
    order = ["_form_side", "_form_seq", "_side", "seq"]
    numbered = number_rows(placed.drop("_form"), order, "position")
    return numbered.drop("_side", "_form_side", "_form_seq")


def union(registry: DataFrame, source: DataFrame) -> DataFrame:
    """Both dictionaries one after the other, without the source's record id field."""
    return registry.withColumn("origin", F.lit("registry")).unionByName(
        source.filter(F.col("field_name") != RECORD).withColumn("origin", F.lit("source")),
        allowMissingColumns=True,
    )


def drift(registry: DataFrame, source: DataFrame, ignored: DataFrame) -> DataFrame:
    """Source fields the registry does not know, and ignored names the source no longer has."""
    unknown = (
        source.join(registry.select("field_name"), "field_name", "left_anti")
        .join(ignored, "field_name", "left_anti")
        .select("field_name", F.lit("unknown_to_registry").alias("issue"))
    )
    gone = ignored.join(source.select("field_name"), "field_name", "left_anti").select(
        "field_name", F.lit("ignored_but_gone").alias("issue")
    )
    return unknown.unionByName(gone).distinct()


def calculated(*dictionaries: DataFrame) -> DataFrame:
    """Fields with a calculation in their annotation; they cannot be written to."""
    rows = dictionaries[0]
    for d in dictionaries[1:]:
        rows = rows.unionByName(d, allowMissingColumns=True)
    return rows.filter(F.col("annotation").contains(CALC_TAG)).select("field_name", "form_name").distinct()


def ignored_names(flags: DataFrame) -> DataFrame:
    """Names whose flag prints as 1."""
    return flags.filter(F.col("flag").cast("string") == "1").select("field_name").distinct()
