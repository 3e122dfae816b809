"""Provider names to national provider ids, by a join to the provider registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.names import first_last, name_tokens
from rollcall.functions.text import key_text
from rollcall.operators.lookup import attach
from rollcall.schema import KEY, NPI, PROVIDER


def parse(providers: DataFrame) -> DataFrame:
    """Provider rows with ``first`` and ``last`` read from the free text name."""
    return (
        providers.withColumn("_tokens", name_tokens(F.col(PROVIDER)))
        .withColumn("_name", first_last(F.col("_tokens")))
        .select(*providers.columns, "_name.first", "_name.last")
    )


def hits(npi_registry: DataFrame) -> DataFrame:
    """(first, last, n): what a search by last name, or by first and last name, returns.

    ``first`` is blank for the search by last name alone. ``npi`` is set for a single hit.
    """
    rows = npi_registry.select(
        key_text(F.col("first_name")).alias("_f"), key_text(F.col("last_name")).alias("_l"), "npi"
    ).filter("_l <> ''")
    # one shuffle for both searches: a full key and a last-name key per row
    keys = F.array(
        F.when(F.col("_f") != "", F.struct(F.col("_f").alias("first"), F.col("_l").alias("last"))),
        F.struct(F.lit("").alias("first"), F.col("_l").alias("last")),
    )
    return (
        rows.select("npi", F.inline(F.filter(keys, lambda k: k.isNotNull())))
        .groupBy("first", "last")
        .agg(F.min("npi").alias("low"), F.max("npi").alias("high"))
        .select(
            "first",
            "last",
            F.when(F.col("low") == F.col("high"), F.col("low")).alias("npi"),
            (F.col("low") == F.col("high")).alias("single"),
        )
    )


def find_npi(parsed: DataFrame, npi_registry: DataFrame) -> DataFrame:
    """Parsed rows with ``provider_npi`` (blank unless exactly one hit) and ``status``.

    Status: ``no_name``, ``none``, ``several`` or ``one``. A blank name looks nothing up.
    """
    first, last = F.lower("first"), F.lower("last")
    asks = last != ""
    alone = F.concat(F.lit("\u0000"), F.col(KEY).cast("string"))
    probe = parsed.withColumns({"_f": first, "_l": F.when(asks, last).otherwise(alone), "_asks": asks})
    found = hits(npi_registry).select(F.col("first").alias("_f"), F.col("last").alias("_l"), "npi", "single")
    joined = attach(probe, found, ["_f", "_l"])
    status = (
        F.when(~F.col("_asks"), "no_name")
        .when(F.col("single").isNull(), "none")
        .when(F.col("single"), "one")
        .otherwise("several")
    )
    npi = F.when(F.col("_asks") & F.col("single"), F.col("npi").cast("string")).otherwise("")
    return joined.select(*parsed.columns, npi.alias(NPI), status.alias("status"))


def payload(found: DataFrame) -> DataFrame:
    """Key and provider id of the rows with a single hit, for a fill-only upsert."""
    return found.filter(F.col("status") == "one").select(KEY, NPI)
