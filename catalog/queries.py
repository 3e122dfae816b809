"""One query per operator, on the views of ``fixtures``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.fixtures import view
from rollcall.functions import casts
from rollcall.functions.text import clean, has_letter
from rollcall.operators import (
    alerts,
    audit,
    buckets,
    crosswalk,
    dedupe,
    dictionary,
    files,
    intake,
    matching,
    normalize,
    providers,
    publish,
    upsert,
)
from rollcall.plans import jobs
from rollcall.schema import DECLINED, EMPI, INSTANCE, INSTRUMENT, KEY, MRN, NPI, OUTCOMES, RECORD, ROW
from rollcall.session import cut
from rollcall.sources import snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMP = "01/02/2024 00:00:00"
IGNORED = ["note", "gone_upstream"]
ALLOWED = [KEY, RECORD, INSTRUMENT, INSTANCE, "age", "first_name", "finding", "r4_survey_queue_link", "last_r4_pull"]
PROJECT = 3
EVERY_DAYS = 7


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- helpers -----------------------------------------------------------------------


def _registry(spark: SparkSession, d: str) -> DataFrame:
    return normalize.index_registry(view(spark, d, "fx_registry"))


def _source(spark: SparkSession, d: str) -> DataFrame:
    return normalize.index_source(view(spark, d, "fx_source_snapshot"))


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    return matching.tag_steps(_source(spark, d), _registry(spark, d))


def _mapping(spark: SparkSession, d: str) -> DataFrame:
    return matching.link(_source(spark, d), _registry(spark, d))


def _winners(step: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        won = matching.rule_winners(_tagged(spark, d), _registry(spark, d), [step])
        return won.select(KEY, RECORD, "n_records")

    return run


def _published(spark: SparkSession, d: str, framed: bool = False) -> DataFrame:
    source = view(spark, d, "fx_source_raw")
    if framed:  # what landing does, in the checkpoint folder
        source = cut(source.withColumn(ROW, F.monotonically_increasing_id()))
    mapping = publish.plan_batches(publish.add_links(cut(_mapping(spark, d).select(RECORD, KEY)), source))
    if framed:
        mapping = publish.plan_frames(source, cut(mapping))
    return publish.publish_rows(source, mapping, IGNORED, ALLOWED, STAMP)


def _folder(spark: SparkSession, kind: str) -> str:
    """A folder of its own for a stored table, shared by driver and executors."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared}/catalog/{kind}-{uuid.uuid4().hex}"


# --- sources ---------------------------------------------------------------------------


@query
def full_scan(spark, d):
    """Every row of an export, written as JSON lines and read back by the reader."""
    path, rows = _folder(spark, "export"), view(spark, d, "fx_source_snapshot")
    rows.write.json(path)
    return snapshots.read_export(spark, path, rows.columns, lines=True)


@query
def projected_scan(spark, d):
    return snapshots.fields_of(view(spark, d, "fx_registry"), [KEY, MRN, EMPI])


@query
def filtered_scan(spark, d):
    return snapshots.where(view(spark, d, "fx_survey"), "run_date >= DATE'1996-01-01'").select(
        RECORD, "previous_survey_complete"
    )


@query
def point_lookup(spark, d):
    return snapshots.one_record(view(spark, d, "fx_source_raw"), "18").select(RECORD, INSTRUMENT, INSTANCE, "finding")


@query
def point_lookup_landed(spark, d):
    landed = snapshots.land(view(spark, d, "fx_source_raw"), _folder(spark, "source"), RECORD)
    return snapshots.one_record(landed, "18").select(RECORD, INSTRUMENT, INSTANCE, "finding")


@query
def parse_export(spark, d):
    return snapshots.parse_export(view(spark, d, "fx_export_lines"), [RECORD, "age", "status"])


@query
def parse_upload(spark, d):
    return snapshots.parse_upload(view(spark, d, "fx_upload_lines"), [KEY, MRN, "first_local"])


@query
def range_boundaries(spark, d):
    return snapshots.range_boundaries(view(spark, d, "fx_registry"), ids_per_range=50)


@query
def range_records(spark, d):
    cuts = snapshots.range_boundaries(view(spark, d, "fx_registry"), ids_per_range=50)
    return snapshots.range_of_records(view(spark, d, "fx_source"), cuts)


@query
def ignore_list(spark, d):
    return dictionary.ignored_names(view(spark, d, "fx_ignore"))


# --- normalisation -------------------------------------------------------------------------


@query
def normalize_registry(spark, d):
    return normalize.index_registry(view(spark, d, "fx_registry_raw"))


@query
def registry_quarantine(spark, d):
    return normalize.registry_quarantine(view(spark, d, "fx_registry_raw"))


@query
def normalize_source(spark, d):
    return _source(spark, d)


@query
def collapse_source(spark, d):
    raw = view(spark, d, "fx_source_raw")
    return normalize.collapse(raw, [RECORD, "age", "first_name", "survey_queue_link", "note", "finding"])


@query
def clean_age(spark, d):
    raw = view(spark, d, "fx_source_raw")
    return raw.select(RECORD, INSTRUMENT, INSTANCE, casts.to_age(F.col("age")).cast("bigint").alias("age"))


@query
def parse_numbers(spark, d):
    text = F.col("num_text")
    return view(spark, d, "fx_numbers").select(
        "event_id", casts.to_key(text).alias("num"), casts.to_number_or_zero(text).alias("num_or_zero")
    )


@query
def parse_stamps(spark, d):
    return view(spark, d, "fx_stamps").select("event_id", casts.to_seconds(F.col("stamp_text")).alias("seconds"))


@query
def parse_dates(spark, d):
    day = casts.to_day(F.col("dob_text"))
    return view(spark, d, "fx_dates").select("event_id", day.cast("string").alias("dob"))


@query
def format_dates(spark, d):
    day = casts.to_day(F.col("dob_text"))
    return view(spark, d, "fx_dates").select("event_id", casts.day_text(day).alias("dob_us"))


@query
def has_name(spark, d):
    return view(spark, d, "fx_names").select("page_id", has_letter(F.col("name_text")).alias("named"))


@query
def clean_text(spark, d):
    raw = view(spark, d, "fx_source_raw")
    return raw.select(RECORD, INSTANCE, *[clean(F.col(c)).alias(c) for c in ("age", "first_name", "note")])


@query
def column_policy(spark, d):
    raw = normalize.drop_columns(view(spark, d, "fx_source_raw"), IGNORED)
    return normalize.keep_columns(raw, ALLOWED)


@query
def constant_columns(spark, d):
    rows = view(spark, d, "fx_registry").select(KEY)
    return normalize.add_constants(rows, {"last_r4_pull": STAMP, "local_batch_upload": "1"})


@query
def complete_rows(spark, d):
    return normalize.complete(view(spark, d, "fx_registry"), [RECORD, "first_local", "last_local", "dob"]).select(KEY)


@query
def adult_child_split(spark, d):
    rows = _source(spark, d)
    return (
        normalize.adults(rows)
        .select(RECORD, F.lit("adult").alias("part"))
        .unionByName(normalize.children(rows).select(RECORD, F.lit("child").alias("part")))
    )


@query
def base_repeat_split(spark, d):
    raw = view(spark, d, "fx_source_raw")
    return raw.select(RECORD, INSTANCE, normalize.is_base().alias("is_base"))


@query
def declined_rows(spark, d):
    reg = view(spark, d, "fx_registry")
    return reg.filter(normalize.any_code(reg, DECLINED, OUTCOMES)).select(KEY)


# --- matching ------------------------------------------------------------------------------------


@query
def match_steps(spark, d):
    return _tagged(spark, d).select(RECORD, F.col("step").cast("bigint").alias("step"))


@query
def match_known(spark, d):
    return matching.known_candidates(_tagged(spark, d), _registry(spark, d)).select(KEY, RECORD)


QUERIES["match_lab"] = _winners(matching.BY_LAB)
QUERIES["match_adult"] = _winners(matching.BY_ADULT)
QUERIES["match_child"] = _winners(matching.BY_CHILD)


@query
def new_ids(spark, d):
    return matching.new_ids(_tagged(spark, d), _registry(spark, d))


@query
def match_mapping(spark, d):
    return _mapping(spark, d).select(RECORD, KEY, F.col("step").cast("bigint").alias("step"))


@query
def match_conflicts(spark, d):
    return matching.conflicts(view(spark, d, "fx_registry_history"))


# --- publishing --------------------------------------------------------------------------------------


@query
def link_enrichment(spark, d):
    return publish.add_links(cut(_mapping(spark, d).select(RECORD, KEY)), view(spark, d, "fx_source_raw"))


@query
def publish_rows(spark, d):
    return _published(spark, d)


@query
def publish_quarantine(spark, d):
    rows = publish.superseded(view(spark, d, "fx_source_raw"), _mapping(spark, d))
    return rows.select(RECORD, INSTRUMENT, INSTANCE, "reason")


@query
def quarantine_all(spark, d):
    raw = view(spark, d, "fx_source_raw")
    held = publish.held_rows(raw, _mapping(spark, d), normalize.source_quarantine(raw))
    return held.select(RECORD, INSTRUMENT, INSTANCE, "reason")


@query
def publish_batches(spark, d):
    return publish.receipts(publish.payload_lines(_published(spark, d)))


@query
def batch_lines(spark, d):
    return publish.payload_lines(_published(spark, d)).select("batch_id", KEY, "instrument", "instance", "line")


@query
def batch_payload(spark, d):
    framed = publish.framed_lines(publish.payload_lines(_published(spark, d, framed=True)))
    return framed.select("batch_id", KEY, "instrument", "instance", "framed")


# --- upserts and deletes -------------------------------------------------------------------------------


def _target(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_registry").select(KEY, MRN, "last_local").withColumn("local_batch_upload", F.lit(""))


@query
def upsert_overwrite(spark, d):
    return upsert.upsert(_target(spark, d), view(spark, d, "fx_payload"))


@query
def upsert_normal(spark, d):
    return upsert.upsert(_target(spark, d), view(spark, d, "fx_payload"), fill=True)


@query
def upsert_patch(spark, d):
    return upsert.upsert(_target(spark, d), view(spark, d, "fx_payload"), fill=True, patch=True)


def _bucketed(spark: SparkSession, d: str, table: DataFrame) -> str:
    """The table in eight buckets or so."""
    path = _folder(spark, "registry")
    buckets.create(table, path, rows_per_bucket=max(1, table.count() // 8))
    return path


@query
def upsert_pruned(spark, d):
    path = _bucketed(spark, d, _target(spark, d))
    buckets.merge(spark, path, view(spark, d, "fx_payload"))
    return buckets.read(spark, path)


@query
def delete_pruned(spark, d):
    path = _bucketed(spark, d, view(spark, d, "fx_registry").select(KEY, MRN))
    buckets.delete(spark, path, view(spark, d, "fx_delete_ids"))
    return buckets.read(spark, path)


@query
def delete_by_ids(spark, d):
    return upsert.delete_keys(view(spark, d, "fx_registry"), view(spark, d, "fx_delete_ids")).select(KEY, MRN)


@query
def delete_receipt(spark, d):
    return upsert.delete_receipt(view(spark, d, "fx_registry"), view(spark, d, "fx_delete_ids"))


# --- duplicates ---------------------------------------------------------------------------------------------


def _duplicates(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.find_duplicates(dedupe.index_for_dedupe(view(spark, d, "fx_registry")))


@query
def dup_groups(spark, d):
    return _duplicates(spark, d).select(
        KEY, "first_local", "last_local", F.col("dob").cast("string").alias("dob"), "child_first", RECORD
    )


@query
def dup_verdicts(spark, d):
    return dedupe.verdicts(_duplicates(spark, d)).select(KEY, "verdict", "declined", "group_linked")


@query
def dup_delete_applied(spark, d):
    doomed = dedupe.reports(dedupe.verdicts(_duplicates(spark, d)))["to_delete"]
    return upsert.delete_keys(view(spark, d, "fx_registry"), doomed).select(KEY)


@query
def dup_cross_source(spark, d):
    return dedupe.cross_source_groups(view(spark, d, "fx_registry_aged"), _source(spark, d)).select(
        "side", "member", "adult", "n_registry", "n_source", "n_adult"
    )


# --- intake ----------------------------------------------------------------------------------------------------


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return intake.judge(view(spark, d, "fx_intake"), view(spark, d, "fx_registry"))


@query
def existing_names(spark, d):
    return intake.existing_names(view(spark, d, "fx_registry"))


@query
def intake_rejects(spark, d):
    return intake.rejects(_judged(spark, d)).select(KEY, MRN, "reason")


@query
def intake_accepted(spark, d):
    return intake.accept(_judged(spark, d), view(spark, d, "fx_registry"))


@query
def intake_repeats(spark, d):
    return intake.repeats_inside(view(spark, d, "fx_intake_twice")).select(KEY, "n_rows")


# --- crosswalks ----------------------------------------------------------------------------------------------------


def _walked(spark: SparkSession, d: str) -> DataFrame:
    return crosswalk.crosswalk(view(spark, d, "fx_registry"), view(spark, d, "fx_patient_map"))


@query
def crosswalk_filled(spark, d):
    return crosswalk.filled(_walked(spark, d))


@query
def crosswalk_issues(spark, d):
    return crosswalk.issues(_walked(spark, d))


@query
def crosswalk_upsert(spark, d):
    table = view(spark, d, "fx_registry").select(KEY, MRN, EMPI)
    return upsert.upsert(table, crosswalk.filled(_walked(spark, d)), fill=True, patch=True)


@query
def crosswalk_repeats(spark, d):
    rows = view(spark, d, "fx_registry_rows")
    return jobs.on_base(rows, crosswalk.filled(crosswalk.crosswalk(rows, view(spark, d, "fx_patient_map"))))


@query
def provider_parse(spark, d):
    return providers.parse(view(spark, d, "fx_provider")).select(KEY, "first", "last")


def _found(spark: SparkSession, d: str) -> DataFrame:
    return providers.find_npi(providers.parse(view(spark, d, "fx_provider")), view(spark, d, "fx_npi"))


@query
def provider_npi(spark, d):
    return _found(spark, d).select(KEY, NPI, "status")


@query
def provider_update(spark, d):
    table = view(spark, d, "fx_provider").withColumn(NPI, F.lit(""))
    return upsert.upsert(table, providers.payload(_found(spark, d)), fill=True, patch=True)


# --- dictionaries -----------------------------------------------------------------------------------------------------


def _dicts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return view(spark, d, "fx_dict_registry"), view(spark, d, "fx_dict_source")


@query
def dict_merge(spark, d):
    return dictionary.merge(*_dicts(spark, d)).select("position", "field_name", "form_name", "annotation", "origin")


@query
def dict_merge_override(spark, d):
    merged = dictionary.merge(*_dicts(spark, d), from_source=["standard", "economy"])
    return merged.select("position", "field_name", "form_name", "annotation", "origin")


@query
def dict_union(spark, d):
    return dictionary.union(*_dicts(spark, d)).select("origin", "field_name", "form_name", "seq")


@query
def dict_drift(spark, d):
    ignored = dictionary.ignored_names(view(spark, d, "fx_ignore"))
    return dictionary.drift(*_dicts(spark, d), ignored)


@query
def dict_calc(spark, d):
    return dictionary.calculated(*_dicts(spark, d))


# --- audits ---------------------------------------------------------------------------------------------------------------


@query
def audit_name_mismatch(spark, d):
    # the registry's names of one in four rows differ, so that the report has rows
    reg = _registry(spark, d)
    altered = F.when(F.col(KEY) % 4 == 0, F.concat(F.lit("x"), F.col("first_local"))).otherwise(F.col("first_local"))
    return audit.name_mismatches(_source(spark, d), _mapping(spark, d), reg.withColumn("first_local", altered)).select(
        RECORD, KEY, "first_name", "first_local"
    )


@query
def audit_id_mismatch(spark, d):
    return audit.id_mismatches(_mapping(spark, d), _registry(spark, d))


@query
def audit_id_repeats(spark, d):
    return audit.id_mismatches(_mapping(spark, d), view(spark, d, "fx_registry_rows"))


@query
def verified_lookup(spark, d):
    return audit.verified_lookup(view(spark, d, "fx_lookup"), view(spark, d, "fx_registry")).select(
        "request_id", KEY, RECORD, "status"
    )


@query
def exactly_one(spark, d):
    return audit.exactly_one(view(spark, d, "fx_patient_map"), "local_pt_id", "empi")


# --- alerts and files --------------------------------------------------------------------------------------------------------


@query
def alert_eligible(spark, d):
    return alerts.eligible(view(spark, d, "fx_survey")).select(RECORD, "survey_queue_link")


@query
def alert_schedule(spark, d):
    due = alerts.eligible(view(spark, d, "fx_survey"))
    plan = alerts.schedule(due, view(spark, d, "fx_survey_sent"), EVERY_DAYS)
    return plan.select(
        RECORD,
        F.col("send_no").cast("bigint").alias("send_no"),
        F.col("send_date").cast("string").alias("send_date"),
        "survey_queue_link",
    )


@query
def alert_ledger(spark, d):
    due = alerts.eligible(view(spark, d, "fx_survey"))
    plan = cut(alerts.schedule(due, view(spark, d, "fx_survey_sent"), EVERY_DAYS))
    ledger = spark.createDataFrame([], f"{RECORD} bigint, send_no int, send_date date, run bigint")
    for day, run in (("1996-06-30", 1), ("1996-06-30", 1), ("1997-06-30", 2)):  # the first run is repeated
        ledger = cut(alerts.ledger_after(plan, ledger, day, run))
    return ledger.select(RECORD, F.col("send_no").cast("bigint").alias("send_no"), F.col("send_date").cast("string").alias("send_date"), "run")


def _reset(part: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        ledgers = [view(spark, d, f"fx_alerts{n}") for n in ("", "_sent", "_recurrence", "_sent_log")]
        split = alerts.reset(*ledgers, PROJECT)
        keys = {"sent": "alert_sent_id", "recurrence": "recurrence_id", "sent_log": "log_id"}
        out = [
            split[n][part].select(F.lit(n).alias("ledger"), F.col(k).cast("bigint").alias("row_id"))
            for n, k in keys.items()
        ]
        return out[0].unionByName(out[1]).unionByName(out[2])

    return run


QUERIES["alert_reset"] = _reset(0)
QUERIES["alert_kept"] = _reset(1)


@query
def file_manifest(spark, d):
    return files.pending(view(spark, d, "fx_files"), view(spark, d, "fx_file_repo"), ["json_file", "pdf_file"])


@query
def stage_counts(spark, d):
    stages = {"registry": _registry(spark, d), "source": _source(spark, d), "mapping": _mapping(spark, d), "duplicates": _duplicates(spark, d)}
    return audit.stored_and_counted(stages)[1]
