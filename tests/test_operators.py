from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import alerts, audit, crosswalk, dedupe, dictionary, files, intake, providers, publish, upsert
from rollcall.schema import INSTANCE, INSTRUMENT, INTAKE_FIELDS, KEY, MRN, OUTCOMES, RECORD, ROW, all_strings

# --- duplicates -------------------------------------------------------------------------

DUP_FIELDS = [KEY, "last_local", "first_local", "dob", "last_child", "child_first", "dob_child", RECORD, "participant_lab_id", *OUTCOMES]


def dup_rows(spark, rows):
    data = [tuple(str(r.get(n, "")) for n in DUP_FIELDS) for r in rows]
    return dedupe.index_for_dedupe(spark.createDataFrame(data, all_strings(DUP_FIELDS)))


def who(key, name="ana", **more):
    return {KEY: key, "first_local": name, "last_local": "diaz", "dob": "1970-01-01", **more}


def judge(spark, rows, **options):
    judged = dedupe.verdicts(dedupe.find_duplicates(dup_rows(spark, rows), **options)).collect()
    return {(r[KEY], r.first_local): r.verdict for r in judged}


def test_linked_group_is_kept_whole(spark):
    got = judge(spark, [who(1, record_id="7"), who(2), who(3, rec_outcome="9")])
    assert got == {(k, "ana"): "keep_linked" for k in (1, 2, 3)}


def test_declined_then_largest(spark):
    rows = [who(1, rec_outcome_2="9"), who(2, rec_outcome="9"), who(3), who(4, "bo"), who(5, "bo")]
    assert judge(spark, rows) == {
        (1, "ana"): "delete",
        (2, "ana"): "keep_declined",
        (3, "ana"): "delete",
        (4, "bo"): "delete",
        (5, "bo"): "keep_largest",
    }


def test_id_in_two_groups_keeps_one_verdict(spark):
    """3 is protected by the linked group, so 2 is all that is left to keep of the other."""
    rows = [who(1, record_id="7"), who(3), who(2, "bo"), who(3, "bo")]
    assert judge(spark, rows) == {
        (1, "ana"): "keep_linked",
        (3, "ana"): "keep_linked",
        (3, "bo"): "keep_linked",
        (2, "bo"): "keep_largest",
    }


def test_children_join_the_group_unless_protected(spark):
    rows = [who(1), who(2), who(9, child_first="kid")]
    assert judge(spark, rows) == {(1, "ana"): "delete", (2, "ana"): "delete", (9, "ana"): "keep_largest"}
    assert judge(spark, rows, protect_children=True) == {(1, "ana"): "delete", (2, "ana"): "keep_largest"}


def test_no_group_without_a_date_or_second_id(spark):
    assert judge(spark, [who(1, dob=""), who(2, dob="bad"), who(3, "bo"), who(3, "bo")]) == {}


def by_hand(rows):
    """Keep and delete decisions by sets of ids, one rule after the other."""
    group = lambda r: (r["dob"], r["first_local"], r["last_local"])
    ids = {}
    for r in rows:
        if r.get("child_first", "") == "":
            ids.setdefault(group(r), set()).add(r[KEY])
    dups = [r for r in rows if len(ids.get(group(r), ())) > 1]
    linked_groups = {group(r) for r in dups if r.get(RECORD)}
    linked = {r[KEY] for r in dups if group(r) in linked_groups}
    free = [r for r in dups if r[KEY] not in linked]
    refused_ids = {r[KEY] for r in free if any(r.get(o) == "9" for o in OUTCOMES)}
    refused = [r for r in free if r[KEY] in refused_ids]
    refused_groups = {group(r) for r in refused}
    settled = {r[KEY] for r in free if group(r) in refused_groups}
    keep = set(linked)
    for part in (refused, [r for r in free if r[KEY] not in settled]):
        for g in {group(r) for r in part}:
            keep.add(max(r[KEY] for r in part if group(r) == g))
    return {r[KEY] for r in dups}, keep


@pytest.mark.parametrize("seed", range(4))
def test_verdicts_equal_sets_by_hand(spark, seed):
    rnd = random.Random(seed)
    rows = [
        who(
            rnd.randrange(1, 60),
            rnd.choice(["ana", "bo", "cy", "dee", "eve", f"n{i % 25}"]),
            **{RECORD: rnd.choice(["", "", "", "", "", "", "7"]), "rec_outcome": rnd.choice(["", "", "9"])},
            child_first=rnd.choice(["", "", "", "kid"]),
        )
        for i in range(120)
    ]
    members, keep = by_hand(rows)
    got = dedupe.verdicts(dedupe.find_duplicates(dup_rows(spark, rows))).collect()
    assert {r[KEY] for r in got} == members
    assert {r[KEY] for r in got if r.verdict != "delete"} == keep & members


# --- publishing ---------------------------------------------------------------------------


def wide(spark, rows):
    names = [RECORD, INSTRUMENT, INSTANCE, "survey_queue_link", "q1", "secret"]
    return spark.createDataFrame([tuple(r) for r in rows], all_strings(names))


def test_publish_fans_out_blanks_repeats_and_quarantines(spark):
    source = wide(
        spark,
        [
            ("A1", "", "", "http://a", None, "s"),
            ("A1", "visit", "1", "", "x", "s"),
            ("2", "", "", "http://b", "y", "s"),
        ],
    )
    mapping = spark.createDataFrame([("a1", 10), ("a1", 11)], f"{RECORD} string, {KEY} long")
    mapping = publish.add_links(mapping, source)
    allowed = [KEY, RECORD, INSTRUMENT, INSTANCE, "q1", "secret", "r4_survey_queue_link", "last_r4_pull"]
    rows = publish.publish_rows(source, mapping, ["secret", "not_there"], allowed, "now")
    assert "secret" not in rows.columns and "survey_queue_link" not in rows.columns
    got = sorted((r[KEY], r[INSTRUMENT], r[RECORD], r["r4_survey_queue_link"], r["last_r4_pull"], r["q1"]) for r in rows.collect())
    assert got == [
        (10, "", "A1", "http://a", "now", ""),
        (10, "visit", "", "", "", "x"),
        (11, "", "A1", "http://a", "now", ""),
        (11, "visit", "", "", "", "x"),
    ]
    assert [(r[RECORD], r.reason) for r in publish.superseded(source, mapping).collect()] == [("2", "superseded")]


def test_batches_hold_whole_ids_and_big_ones_stay_lines(spark):
    mapping = spark.range(1, 24).select(F.col("id").cast("string").alias(RECORD), F.col("id").alias(KEY))
    plan = publish.plan_batches(mapping, keys_per_batch=5)
    assert [r["count"] for r in plan.groupBy("batch_id").count().orderBy("batch_id").collect()] == [5, 5, 5, 5, 3]
    # id 7 holds a third of all rows
    copies = F.when(F.col(KEY) == 7, 60).otherwise(5)
    rows = plan.withColumn(INSTANCE, F.explode(F.sequence(F.lit(1), copies).cast("array<string>"))).withColumn(INSTRUMENT, F.lit("v"))
    landed = rows.select(RECORD, INSTRUMENT, INSTANCE).withColumn(ROW, F.monotonically_increasing_id()).cache()
    framed_plan = publish.plan_frames(landed, plan, rows_per_file=40)
    rows = publish.publish_rows(landed, framed_plan.withColumn("r4_survey_queue_link", F.lit("")), [], [KEY, INSTRUMENT, INSTANCE], "now")
    lines = publish.payload_lines(rows)
    receipt = {r.batch_id: r for r in publish.receipts(lines).collect()}
    assert {b: r.n_rows for b, r in receipt.items()} == {1: 25, 2: 80, 3: 25, 4: 25, 5: 15}
    assert (receipt[2].first_key, receipt[2].last_key, receipt[2].n_keys) == (6, 10, 5)
    framed = publish.framed_lines(lines).orderBy("batch_id", "place").collect()
    parsed = {b: json.loads("".join(r.framed for r in framed if r.batch_id == b)) for b in receipt}
    assert {b: len(p) for b, p in parsed.items()} == {1: 25, 2: 80, 3: 25, 4: 25, 5: 15}
    assert [p[INSTANCE] for p in parsed[1][:5]] == ["1", "2", "3", "4", "5"]
    files = publish.in_files(rows, 40).withColumn("p", F.spark_partition_id())
    spread = {r.batch_id: set(r.ps) for r in files.groupBy("batch_id").agg(F.collect_set("p").alias("ps")).collect()}
    assert len(spread[2]) > 1 and all(len(spread[b]) == 1 and not spread[b] & spread[2] for b in (1, 3, 4, 5))
    assert spread[1] <= spread[3] or max(spread[1]) <= min(spread[3])
    ordered = publish.in_batch_order(lines, 6).select("batch_id", KEY, F.spark_partition_id().alias("p"))
    assert ordered.filter(F.col(KEY) == 7).select("p").distinct().count() > 1


# --- upserts ---------------------------------------------------------------------------------


@pytest.mark.parametrize("patch", [False, True])
def test_two_upsert_modes(spark, patch):
    table = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], f"{KEY} long, mrn string, note string")
    payload = spark.createDataFrame([(1, ""), (2, "B"), (9, "n"), (8, None)], f"{KEY} long, mrn string")
    run = lambda fill: {tuple(r) for r in upsert.upsert(table, payload, fill=fill, patch=patch).collect()}
    assert run(False) == {(1, "", "x"), (2, "B", ""), (3, "c", "z"), (9, "n", ""), (8, "", "")}
    assert run(True) == {(1, "a", "x"), (2, "B", ""), (3, "c", "z"), (9, "n", ""), (8, "", "")}
    once = upsert.upsert(table, payload, patch=patch)
    assert {tuple(r) for r in upsert.upsert(once, payload, patch=patch).collect()} == run(False)
    with pytest.raises(ValueError, match="fields not found"):
        upsert.upsert(table, payload.withColumn("other", F.lit("")), patch=patch)


def test_last_row_per_key(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], f"{KEY} long, mrn string, at int")
    assert {tuple(r) for r in upsert.one_per_key(rows, [KEY], "at").collect()} == {(1, "b", 2), (2, "c", 1)}


def test_delete_and_receipt(spark):
    table = spark.createDataFrame([(1,), (1,), (2,)], f"{KEY} long")
    ids = spark.createDataFrame([(1,), (1,), (7,)], f"{KEY} long")
    assert [r[0] for r in upsert.delete_keys(table, ids).collect()] == [2]
    assert {tuple(r) for r in upsert.delete_receipt(table, ids).collect()} == {(1, 2), (7, 0)}


# --- intake --------------------------------------------------------------------------------------


def test_intake_rules_in_order(spark):
    names = [KEY, MRN, "last_local", "first_local", "dob", "last_child", "child_first", "dob_child"]
    existing_names = names + ["last_name", "first_name", "date_of_birth", "last_name_child", "first_name_child", "date_of_birth_child"]
    existing = spark.createDataFrame(
        [
            ("5", "M1", "Diaz", "Ana", "1970-01-01", "", "nan", None, *[""] * 6),
            ("6", "", "", "", "", "", "", "", "ng", "bo", "1980-02-02", "", "", ""),
        ],
        all_strings(existing_names),
    )
    upload = spark.createDataFrame(
        [
            ("u1", "", "a", "b", "1970-01-01", "", "", ""),
            ("u2", "X", "", "b", "1970-01-01", "", "", ""),
            ("u3", "X", "a", "b", "", "", "", ""),
            ("u4", "X", "a", "b", "1970-13-01", "", "", ""),
            ("u5", "M1", "a", "b", "1970-01-01", "", "", ""),
            ("u6", "m1", " DIAZ", "ana ", "01/01/1970", "", "", ""),
            ("u7", "Y", "Ng", "Bo", "1980-02-02", "", "", ""),
            ("u8", "Z9", "Zed", "Al", "1990-03-04", "", "Kid", "2015-06-01"),
            ("u9", "Z8", "Abe", "Al", "1990-03-04", "", "", ""),
        ],
        all_strings(names),
    )
    judged = intake.judge(upload.select(*INTAKE_FIELDS), existing)
    assert {r[KEY]: r.reason for r in judged.collect()} == {
        "u1": "blank_mrn",
        "u2": "blank_name",
        "u3": "blank_dob",
        "u4": "bad_date",
        "u5": "known_mrn",
        "u6": "known_person",
        "u7": "known_person",
        "u8": None,
        "u9": None,
    }
    taken = {r.upload_id: r for r in intake.accept(judged, existing).collect()}
    assert {u: r[KEY] for u, r in taken.items()} == {"u9": 7, "u8": 8}
    assert (taken["u8"].dob, taken["u8"].dob_child, taken["u9"].dob_child) == ("03/04/1990", "06/01/2015", "")
    assert (taken["u8"].mrn, taken["u8"].last_local, taken["u8"].local_batch_upload) == ("z9", "zed", "1")
    assert intake.rejects(judged).count() + len(taken) == upload.count()


# --- crosswalk, providers, dictionaries ------------------------------------------------------------


def test_crosswalk_statuses(spark):
    registry = spark.createDataFrame(
        [(1, "m1", ""), (2, "m2", ""), (3, "e9", ""), (4, "m4", ""), (5, "", ""), (6, "m1", "E0")],
        f"{KEY} long, mrn string, cuimc_empi string",
    )
    pmap = spark.createDataFrame(
        [("e1", "m1", "P"), ("e1", "m1", "UI"), ("e2", "m2", "P"), ("e3", "m2", "UI"), ("e9", "zz", "X"), ("e4", "m4", "X")],
        "empi string, local_pt_id string, facility_code string",
    )
    walked = crosswalk.crosswalk(registry, pmap)
    assert {r[KEY]: r.status for r in walked.collect()} == {
        1: "filled",
        2: "not_unique",
        3: "filled",
        4: "not_found",
        5: "skip_no_mrn",
        6: "skip_has_empi",
    }
    assert {tuple(r) for r in crosswalk.filled(walked).collect()} == {(1, "e1"), (3, "e9")}


def test_provider_search(spark):
    rows = spark.createDataFrame(
        [(1, "Dr. Ana Diaz"), (2, "Dr Diaz"), (3, "Dr Ng"), (4, "Bo Ng"), (5, ""), (6, "Ana Unknown")],
        f"{KEY} long, provider_name string",
    )
    npi = spark.createDataFrame(
        [(100, "Ana", "Diaz"), (101, "Bo", "NG"), (102, "Cy", "Ng"), (103, "", "Diaz")], "npi long, first_name string, last_name string"
    )
    got = {r[KEY]: (r.provider_npi, r.status) for r in providers.find_npi(providers.parse(rows), npi).collect()}
    assert got == {
        1: ("100", "one"),
        2: ("", "several"),
        3: ("", "several"),
        4: ("101", "one"),
        5: ("", "no_name"),
        6: ("", "none"),
    }


def test_dictionary_merge_keeps_forms_together(spark):
    schema = "field_name string, form_name string, seq long, annotation string"
    registry = spark.createDataFrame([("a", "one", 1, ""), ("b", "two", 2, "x @CALC(1)"), ("c", "one", 3, "")], schema)
    source = spark.createDataFrame([("record_id", "zero", 0, ""), ("c", "two", 1, ""), ("d", "one", 2, ""), ("e", "two", 3, "")], schema)
    order = lambda m: [r.field_name for r in m.orderBy("position").collect()]
    assert order(dictionary.merge(registry, source)) == ["a", "c", "d", "b", "e", "record_id"]
    assert order(dictionary.merge(registry, source, ["one"])) == ["b", "c", "e", "record_id", "d"]
    assert dictionary.union(registry, source).count() == 6
    ignored = spark.createDataFrame([("d",), ("gone",)], "field_name string")
    drift = {tuple(r) for r in dictionary.drift(registry, source, ignored).collect()}
    assert drift == {("record_id", "unknown_to_registry"), ("e", "unknown_to_registry"), ("gone", "ignored_but_gone")}
    assert [tuple(r) for r in dictionary.calculated(registry, source).collect()] == [("b", "two")]


# --- audits, alerts, files ------------------------------------------------------------------------------


def test_blank_lab_equals_blank_and_blank_name_is_a_value(spark):
    mapping = spark.createDataFrame([("7", 1), ("8", 2), ("9", 3)], f"{RECORD} string, {KEY} long")
    source = spark.createDataFrame(
        [("7", "", "ana", "d", ""), ("8", "l", "", "d", ""), ("9", "x", "bo", "d", "")],
        f"{RECORD} string, participant_lab_id string, first_name string, last_name string, date_of_birth string",
    )
    registry = spark.createDataFrame(
        [(1, "", "anna", "d", ""), (2, "l", "cy", "d", ""), (3, "y", "other", "d", "")],
        f"{KEY} long, participant_lab_id string, first_local string, last_local string, dob string",
    )
    assert {r[KEY] for r in audit.name_mismatches(source, mapping, registry).collect()} == {1, 2}


def test_alert_plan_and_reset(spark):
    surveys = spark.sql(
        "select * from values (1,'2','',date'2024-01-01'),(2,'2','2',date'2024-01-01'),(3,'0','',date'2024-01-01'),"
        "(4,'2',null,date'2024-01-01') as t(record_id, previous_survey_complete, reminder_survey_complete, run_date)"
    )
    sent = spark.sql("select 4 as record_id")
    plan = alerts.schedule(alerts.eligible(surveys), sent, every_days=7)
    assert [(r.record_id, r.send_no, str(r.send_date)) for r in plan.orderBy("send_no").collect()] == [
        (1, 1, "2024-01-01"),
        (1, 2, "2024-01-08"),
        (1, 3, "2024-01-15"),
    ]
    table = lambda cols, *rows: spark.createDataFrame(list(rows), cols)
    out = alerts.reset(
        table("alert_id int, project_id int", (1, 3), (2, 4)),
        table("alert_sent_id int, alert_id int", (10, 1), (11, 2), (12, None)),
        table("alert_id int", (1,), (2,)),
        table("alert_sent_id int, text string", (10, "a"), (11, "b"), (12, "c")),
        project_id=3,
    )
    sizes = {n: (gone.count(), kept.count()) for n, (gone, kept) in out.items()}
    assert sizes == {"sent": (1, 2), "recurrence": (1, 1), "sent_log": (1, 2)}


def test_pending_files(spark):
    snap = spark.createDataFrame([("1", "a.json", "a.pdf"), ("2", "", "b.pdf"), ("3", None, "c.pdf")], "record_id string, j string, p string")
    stored = spark.createDataFrame([("b.pdf",)], "file_name string")
    got = {tuple(r) for r in files.pending(snap, stored, ["j", "p"]).collect()}
    assert got == {("1", "j", "a.json"), ("1", "p", "a.pdf"), ("3", "p", "c.pdf")}
