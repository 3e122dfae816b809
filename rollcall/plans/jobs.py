"""The jobs: sync, duplicate review, intake, mapping audit, id crosswalks, dictionaries, alerts.

Each takes frames and an output folder, writes its tables there and returns their paths.
Stage counts are taken from what was written, so nothing wide is computed twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators import alerts, audit, buckets, crosswalk, dedupe, dictionary, intake, matching, normalize, providers, publish, upsert
from rollcall.schema import INSTANCE, INSTRUMENT, KEY, KEYS_PER_BATCH, NPI, PROVIDER, RECORD, ROW
from rollcall.session import cut
from rollcall.sources.sinks import write_counted, write_dictionary, write_report, write_table
from rollcall.sources.snapshots import land, one_record, range_boundaries, read_ranges


def _back(df: DataFrame, path: str) -> DataFrame:
    """What was written, read again."""
    return df.sparkSession.read.parquet(path)


def sync(
    registry: DataFrame,
    source: DataFrame,
    ignored: list[str] | DataFrame,
    allowed: list[str],
    stamp: str,
    out: str,
    record_id: str | None = None,
    keys_per_batch: int = KEYS_PER_BATCH,
    reserved_from: int | None = None,
    apply: bool = False,
    rows_per_file: int = publish.ROWS_PER_FILE,
) -> dict[str, str]:
    """Link the source to the registry and prepare its batches.

    Both exports are parsed once and landed (``registry_in``, ``source_in``); every later step reads the landed columns it needs.
    Writes ``mapping``, ``rows`` (what is published, with its batch and place), ``batches`` (the same as framed payload
    lines: those of a batch, in the order of ``place``, are one JSON array), ``receipts``, ``quarantine`` (source rows not
    published, registry keys not readable) and ``stages`` (row counts, observed while the tables were written). With ``apply``
    also ``registry``, the full registry snapshot after the import. ``record_id`` limits the run to one record. ``ignored``
    names fields, or is the table of flags (``read_flags``).
    """
    if isinstance(ignored, DataFrame):
        ignored = [r.field_name for r in dictionary.ignored_names(ignored).collect()]
    names = ("registry_in", "source_in", "mapping", "rows", "batches", "receipts", "quarantine", "stages")
    paths = {n: f"{out}/{n}" for n in names}
    table = land(registry, paths["registry_in"]).drop(ROW)
    if table.isEmpty():
        raise ValueError("the registry snapshot is empty")
    source = land(source if record_id is None else one_record(source, record_id), paths["source_in"])
    counts: dict[str, int] = {}

    people = normalize.index_registry(table)
    records = normalize.index_source(source)
    linked = cut(matching.link(records, people, reserved_from))
    planned = cut(publish.plan_batches(publish.add_links(linked, source), keys_per_batch))
    seen = write_counted(planned, paths["mapping"], new_ids=F.count_if(F.col("step") == matching.NEW))
    counts |= {"mapping": seen["n_rows"], "new_ids": seen["new_ids"]}
    mapping = _back(table, paths["mapping"])

    framed = publish.plan_frames(source, mapping.drop("step"), rows_per_file)
    published = cut(publish.publish_rows(source, framed, ignored, allowed, stamp))
    write_table(publish.in_files(published, rows_per_file), paths["rows"])
    rows = _back(table, paths["rows"])
    lines = publish.payload_lines(rows)
    counts["published_rows"] = write_counted(publish.framed_lines(lines), paths["batches"])["n_rows"]
    counts["batches"] = write_counted(publish.receipts(lines), paths["receipts"])["n_rows"]

    late = publish.held_rows(source, mapping, normalize.source_quarantine(source))
    keys = normalize.registry_quarantine(table).select(F.col(KEY).cast("string").alias(KEY), "reason")
    held = late.select(RECORD, INSTRUMENT, INSTANCE, "reason")
    counts["quarantine"] = write_counted(held.unionByName(keys, allowMissingColumns=True), paths["quarantine"])["n_rows"]

    write_table(audit.stage_counts(table.sparkSession, counts), paths["stages"])
    if apply:
        paths["registry"] = f"{out}/registry"
        write_table(apply_rows(table, rows), paths["registry"])
    return paths


def apply_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Registry table after an overwriting import of published rows, base and repeats."""
    return upsert.upsert(table, _payload(rows, dict(table.dtypes)[KEY]), [KEY, INSTRUMENT, INSTANCE])


def sync_database(
    registry: DataFrame,
    url: str,
    table: str,
    ignored: list[str] | DataFrame,
    allowed: list[str],
    stamp: str,
    out: str,
    tasks: int = 64,
    unreadable: str | None = None,
    options: dict[str, str] | None = None,
    **more: object,
) -> dict[str, str]:
    """``sync`` of a source that is a database table, read by ranges of the record ids that the registry knows.

    The ids are dealt into ``tasks`` ranges of equal size, so each connection reads about as many known records; ids below the first, missing and
    unreadable ones have a range of their own, so every row is read once. ``options`` go to the connection, ``more`` to ``sync``.
    """
    cuts = range_boundaries(registry, tasks=tasks)
    source = read_ranges(registry.sparkSession, url, table, cuts, RECORD, unreadable, **(options or {}))
    return sync(registry, source, ignored, allowed, stamp, out, **more)


def _payload(rows: DataFrame, kind: str) -> DataFrame:
    return rows.drop(publish.BATCH, *publish.FRAME).withColumn(KEY, F.col(KEY).cast(kind))


def keep_registry(registry: DataFrame, path: str, rows_per_bucket: int = buckets.ROWS) -> None:
    """Store the registry in key buckets, for ``import_rows`` and ``remove_ids``."""
    buckets.create(registry, path, KEY, rows_per_bucket)


def import_rows(rows: DataFrame, path: str) -> list[int]:
    """Overwriting import of published rows, base and repeats, into a stored registry; rewrites the touched buckets alone."""
    spark = rows.sparkSession
    kind = dict(buckets.read(spark, path).dtypes)[KEY]
    return buckets.merge(spark, path, _payload(rows, kind), [KEY, INSTRUMENT, INSTANCE])


def remove_ids(ids: DataFrame, path: str, out: str) -> list[int]:
    """Take ids out of a stored registry, with a receipt of the rows that each removed; rewrites the touched buckets alone."""
    spark = ids.sparkSession
    named = buckets.touched(ids, buckets.bounds(spark, path))
    write_report(upsert.delete_receipt(buckets.read(spark, path, named), ids), f"{out}/receipt", [KEY])
    return buckets.delete(spark, path, ids)


def on_base(registry: DataFrame, payload: DataFrame) -> DataFrame:
    """Registry after a filling import by id: base rows take part, repeat rows stay as they are."""
    done = upsert.upsert(normalize.base_rows(registry), payload, fill=True, patch=True)
    if INSTRUMENT not in registry.columns:
        return done
    return done.unionByName(registry.filter(~normalize.is_base()))


def delete_ids(registry: DataFrame, ids: DataFrame, out: str) -> dict[str, str]:
    """Registry without the listed ids, and a receipt with the rows that each id removes."""
    paths = {n: f"{out}/{n}" for n in ("registry", "receipt")}
    write_table(upsert.delete_keys(registry, ids), paths["registry"])
    write_report(upsert.delete_receipt(registry, ids), paths["receipt"], [KEY])
    return paths


def review_duplicates(registry: DataFrame, out: str, protect_children: bool = False) -> dict[str, str]:
    """Four CSV reports: declined, linked to the source, to delete, kept."""
    found = dedupe.find_duplicates(dedupe.index_for_dedupe(registry), protect_children)
    judged = cut(dedupe.verdicts(found))
    order = [*dedupe.GROUP, "child_first", "last_child", "dob_child", KEY]
    paths = {}
    for name, rows in dedupe.reports(judged).items():
        paths[name] = f"{out}/{name}"
        write_report(rows, paths[name], order)
    return paths


def take_in(upload: DataFrame, registry: DataFrame, out: str, reserved_from: int | None = None) -> dict[str, str]:
    """Accepted rows with new ids as a table, rejected rows with reasons as CSV."""
    paths = {n: f"{out}/{n}" for n in ("accepted", "rejected", "repeated")}
    judged = cut(intake.judge(upload, registry))
    write_table(intake.accept(judged, registry, reserved_from), paths["accepted"])
    write_report(intake.rejects(judged), paths["rejected"], [KEY])
    write_report(intake.repeats_inside(upload), paths["repeated"], [KEY])
    return paths


def audit_mapping(registry: DataFrame, source: DataFrame, out: str) -> dict[str, str]:
    """Mapping, both indexed sides, first-name mismatches and changed record ids as CSV."""
    people = cut(normalize.index_registry(normalize.base_rows(registry)))
    records = cut(normalize.index_source(source))
    mapping = cut(matching.link(records, normalize.index_registry(registry)))
    tables = {
        "current_mapping": (mapping.select(RECORD, KEY), [KEY]),
        "registry": (people, [KEY]),
        "source": (records, [RECORD]),
        "name_mismatch": (audit.name_mismatches(records, mapping, people), [KEY]),
        "id_mismatch": (audit.id_mismatches(mapping, people), [KEY]),
    }
    paths = {}
    for name, (rows, order) in tables.items():
        paths[name] = f"{out}/{name}"
        write_report(rows, paths[name], order)
    return paths


def fill_enterprise_ids(registry: DataFrame, patient_map: DataFrame, out: str) -> dict[str, str]:
    """Registry with the enterprise ids found, and the rows without one with their reason."""
    paths = {n: f"{out}/{n}" for n in ("registry", "issues")}
    walked = cut(crosswalk.crosswalk(registry, patient_map))
    write_table(on_base(registry, crosswalk.filled(walked)), paths["registry"])
    write_report(crosswalk.issues(walked), paths["issues"], [KEY])
    return paths


def fill_provider_ids(registry: DataFrame, named: DataFrame, npi_registry: DataFrame, out: str) -> dict[str, str]:
    """Registry with the provider ids found, and every name with what the search gave.

    An id named in several rows takes the id found for the last name in text order.
    """
    paths = {n: f"{out}/{n}" for n in ("registry", "searches")}
    found = cut(providers.find_npi(providers.parse(named), npi_registry))
    hits = found.filter("status = 'one'").select(KEY, PROVIDER, NPI)
    payload = upsert.one_per_key(hits, [KEY], PROVIDER).select(KEY, NPI)
    write_table(on_base(registry, payload), paths["registry"])
    write_report(found, paths["searches"], [KEY, PROVIDER])
    return paths


def merge_dictionaries(registry: DataFrame, source: DataFrame, flags: DataFrame, out: str, from_source: list[str] | None = None) -> dict[str, str]:
    """The registry's dictionary with the fields of the source that it lacks, in order; what drifted apart; fields that are computed."""
    paths = {n: f"{out}/{n}" for n in ("dictionary", "drift", "calculated")}
    registry, source = cut(registry), cut(source)
    merged = dictionary.merge(registry, source, from_source) if from_source else dictionary.merge(registry, source)
    write_dictionary(merged, paths["dictionary"])
    write_report(dictionary.drift(registry, source, dictionary.ignored_names(flags)), paths["drift"], ["issue", "field_name"])
    write_report(dictionary.calculated(registry, source), paths["calculated"], ["form_name", "field_name"])
    return paths


def send_alerts(surveys: DataFrame, before: DataFrame, ledger: str, day: str, run: int, every_days: int) -> DataFrame:
    """Put the sends that are due on ``day`` into the ledger folder as the rows of ``run`` and return them.

    The ledger has one folder per run. A run that is repeated replaces its own folder with the same rows, so nobody is written to twice.
    ``before`` names people who were alerted before the ledger began.
    """
    spark = surveys.sparkSession
    schema = f"{RECORD} {dict(surveys.dtypes)[RECORD]}, send_no int, send_date date, run bigint"
    try:
        known = spark.read.schema(schema).parquet(ledger)
    except AnalysisException:  # the first run finds no folder
        known = spark.createDataFrame([], schema)
    plan = alerts.schedule(alerts.eligible(surveys), before, every_days)
    fresh = cut(alerts.new_sends(plan, known, day, run))
    fresh.drop("run").write.mode("overwrite").parquet(f"{ledger}/run={run}")
    return fresh


def reset_alerts(ledgers: dict[str, DataFrame], project_id: int, out: str) -> dict[str, str]:
    """What stays of the ledgers ``sent``, ``recurrence`` and ``sent_log`` when a project starts anew, and the rows taken out."""
    split = alerts.reset(ledgers["alerts"], ledgers["sent"], ledgers["recurrence"], ledgers["sent_log"], project_id)
    paths = {}
    for name, (gone, kept) in split.items():
        for kind, rows in (("removed", gone), ("kept", kept)):
            paths[f"{name}_{kind}"] = f"{out}/{name}_{kind}"
            write_table(rows, paths[f"{name}_{kind}"])
    return paths
