"""Batch uploads: reject reasons, new ids, formatted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.casts import day_text, to_day, to_key
from rollcall.functions.text import key_text
from rollcall.operators.lookup import attach
from rollcall.operators.matching import top_id
from rollcall.operators.normalize import rename_columns
from rollcall.operators.numbering import number_rows
from rollcall.schema import (
    FOREIGN,
    FOREIGN_CHILD,
    INTAKE_FIELDS,
    ISO_DATE,
    KEY,
    MRN,
    OWN,
    OWN_CHILD,
    UPLOAD_FLAG,
)

PERSON = [*OWN, *OWN_CHILD]


def existing_names(registry: DataFrame) -> DataFrame:
    """Distinct people of the registry under both of its name layouts, cleaned."""
    own = registry.select(*PERSON)
    foreign = rename_columns(
        registry.select(*FOREIGN, *FOREIGN_CHILD), dict(zip([*FOREIGN, *FOREIGN_CHILD], PERSON))
    )
    both = own.unionByName(foreign)
    return both.select(*[key_text(F.col(n)).alias(n) for n in PERSON]).distinct()


def judge(upload: DataFrame, registry: DataFrame) -> DataFrame:
    """Upload rows with ``reason``: the first failing rule, or null when accepted.

    All columns of the upload are kept. Medical record numbers are compared as they are, people by six cleaned fields with
    dates as ISO text, where blank equals blank. Rows that failed already look nothing up.
    """
    dates = {n: to_day(F.col(n)) for n in ("dob", "dob_child")}
    empty = lambda n: key_text(F.col(n)) == ""
    unread = lambda n: ~empty(n) & dates[n].isNull()
    early = (
        F.when(empty(MRN), "blank_mrn")
        .when(empty("last_local") | empty("first_local"), "blank_name")
        .when(empty("dob"), "blank_dob")
        .when(unread("dob") | unread("dob_child"), "bad_date")
    )
    others = [c for c in upload.columns if c not in INTAKE_FIELDS]
    rows = upload.select(*INTAKE_FIELDS, *others, early.alias("_early"))
    asks = F.col("_early").isNull()
    alone = F.concat(F.lit("\u0000"), F.col(KEY).cast("string"))

    mrns = registry.filter(F.coalesce(F.col(MRN), F.lit("")) != "").select(F.col(MRN).alias("_mrn")).distinct()
    rows = rows.withColumn("_mrn", F.when(asks, F.col(MRN)).otherwise(alone))
    rows = attach(rows, mrns.withColumn("_known_mrn", F.lit(True)), ["_mrn"])

    clean = {
        n: F.date_format(dates[n], ISO_DATE) if n in dates else key_text(F.col(n)) for n in PERSON
    }
    probe = [f"_{n}" for n in PERSON]
    rows = rows.withColumns({f"_{n}": F.coalesce(c, F.lit("")) for n, c in clean.items()})
    rows = rows.withColumn(probe[0], F.when(asks, F.col(probe[0])).otherwise(alone))
    people = rename_columns(existing_names(registry), dict(zip(PERSON, probe)))
    rows = attach(rows, people.withColumn("_known_person", F.lit(True)), probe)

    late = F.when(asks & F.col("_known_mrn"), "known_mrn").when(asks & F.col("_known_person"), "known_person")
    return rows.select(*INTAKE_FIELDS, *others, F.coalesce("_early", late).alias("reason"))


def rejects(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull())


def accept(judged: DataFrame, registry: DataFrame, reserved_from: int | None = None) -> DataFrame:
    """Accepted rows ready for import: cleaned text, next free ids, upload flag, US dates.

    Ids follow the six person fields in text order, then the id the row came with. Further columns of the upload follow
    as they are.
    """
    others = [c for c in judged.columns if c not in [*INTAKE_FIELDS, "reason", "upload_id", UPLOAD_FLAG]]
    rows = judged.filter(F.col("reason").isNull())
    sort_text = lambda n: F.coalesce(F.date_format(to_day(F.col(n)), ISO_DATE), F.lit(""))
    tidy = rows.select(
        F.col(KEY).alias("_from"),
        to_key(F.col(KEY).cast("string")).alias("_from_no"),
        key_text(F.col(MRN)).alias(MRN),
        *[(sort_text(n) if n.startswith("dob") else key_text(F.col(n))).alias(n) for n in PERSON],
        *others,
    )
    keys = registry.select(to_key(F.col(KEY).cast("string")).alias(KEY))
    numbered = number_rows(
        tidy, [*PERSON, "_from_no", "_from", MRN], KEY, top_id(keys, reserved_from) + 1
    )
    return numbered.select(
        F.col("_from").alias("upload_id"),
        KEY,
        MRN,
        *[(day_text(to_day(F.col(n))) if n.startswith("dob") else F.col(n)).alias(n) for n in PERSON],
        F.lit("1").alias(UPLOAD_FLAG),
        *others,
    )


def repeats_inside(upload: DataFrame) -> DataFrame:
    """Report only: upload rows that name the same person as another row of the upload."""
    probe = [f"_{n}" for n in PERSON]
    rows = upload.withColumns(
        {
            f"_{n}": F.coalesce(F.date_format(to_day(F.col(n)), ISO_DATE), F.lit(""))
            if n.startswith("dob")
            else key_text(F.col(n))
            for n in PERSON
        }
    )
    several = rows.groupBy(*probe).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    return attach(rows, several, probe, "inner").select(*INTAKE_FIELDS, "n_rows")
