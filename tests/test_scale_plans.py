"""Plans and row counts of the steps that must not move or read more than they need."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from catalog.fixtures import view
from rollcall.operators import alerts, audit, files, matching, normalize, publish
from rollcall.operators.numbering import number_rows
from rollcall.plans import jobs
from rollcall.schema import INSTANCE, INSTRUMENT, KEY, LAB, RECORD, ROW
from rollcall.session import cut
from rollcall.sources import sinks, snapshots
from rollcall.streaming.incremental import send_arrivals, sync_arrivals
from tests.people import random_case, registry_frame, source_frame

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- one row per record ----------------------------------------------------------------


def test_first_rows_are_limited_before_the_shuffle(spark):
    raw = view(spark, SF, "fx_source_raw")
    plan = plan_of(normalize.first_rows(raw, [RECORD, "age", "note"]))
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan
    assert "SortAggregate" not in plan_of(normalize.first_values(raw, [RECORD, "age", "note"]))


def test_whole_rows_are_neither_sorted_nor_moved(spark):
    rows = [("1", "", "", "a"), ("2", "", "", "b"), ("2", "v", "1", None), ("3", "v", "1", "c"), ("4", "", "", None), (None, "", "", "d")]
    df = spark.createDataFrame(rows, f"{RECORD} string, {INSTRUMENT} string, {INSTANCE} string, x string")
    first, open_ = normalize.whole_rows(df, [RECORD, "x"])
    assert not any(x in plan_of(first) for x in ("Sort", "Window", "Exchange"))
    assert {tuple(r) for r in first.collect()} == {("1", "a"), ("2", "b"), (None, "d")}
    assert {r[0] for r in open_.collect()} == {"3", "4"}
    more = df.unionByName(spark.createDataFrame([("1", "", "", "0"), (None, "", "", "0")], df.schema))
    first, open_ = normalize.whole_rows(more, [RECORD, "x"])
    assert {tuple(r) for r in first.collect()} == {("1", "0"), ("2", "b"), (None, "0")} and open_.count() == 2


def test_few_numbered_rows_are_stored_in_few_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    try:
        out = number_rows(spark.range(3000, 0, -1).withColumnRenamed("id", "k"), ["k"])
        assert out.rdd.getNumPartitions() < 50
        assert [tuple(r) for r in out.orderBy("k").collect()] == [(k, k) for k in range(1, 3001)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_keys_without_base_rows_are_found_without_a_join(spark):
    rows = [("1", "", "", "a"), ("2", "v", "1", "b"), ("3", "", "0", None), ("1", "v", "2", None)]
    df = spark.createDataFrame(rows, f"{RECORD} string, {INSTRUMENT} string, {INSTANCE} string, x string")
    joins = []
    held, normalize.attach = normalize.attach, lambda *a, **k: joins.append(a) or held(*a, **k)
    try:
        first, open_ = normalize.whole_rows(df, [RECORD, "x"])
    finally:
        normalize.attach = held
    assert not joins
    assert [tuple(r) for r in first.collect()] == [("1", "a")] and {r[0] for r in open_.collect()} == {"2", "3"}


def test_links_are_aggregated_for_mapped_records_alone(spark):
    rows = [(str(k), "", i, f"l{k}{i}") for k in range(9) for i in ("1", "0")]
    source = spark.createDataFrame(rows, f"{RECORD} string, {INSTRUMENT} string, {INSTANCE} string, survey_queue_link string")
    mapping = spark.createDataFrame([("3", 1), ("3", 2), ("x", 3)], f"{RECORD} string, {KEY} long")
    linked = publish.add_links(mapping, source)
    plan = plan_of(linked)
    assert "Join" in plan[plan.rindex("SortAggregate") :]
    assert sorted(tuple(r) for r in linked.select(KEY, "r4_survey_queue_link").collect()) == [(1, "l30"), (2, "l30"), (3, None)]


def test_collapse_by_rule(spark):
    rows = [
        ("1", "", "", None, "b"), ("1", "v", "2", "late", "x"), ("1", "v", "1", "early", "x"),  # null in the base row
        ("2", "", "", "", None), ("2", "a", "1", "z", None),  # a blank is a value; no value at all
        ("3", "", "", "q", "r"), ("3", "", "", "p", "s"),  # two whole base rows: the smaller values
        ("4", "v", "1", "b", "c"), ("4", "v", "1", "a", "d"),  # repeats of one place: smallest value of each column
    ]
    df = spark.createDataFrame(rows, f"{RECORD} string, {INSTRUMENT} string, {INSTANCE} string, x string, y string")
    want = {("1", "early", "b"), ("2", "", None), ("3", "p", "s"), ("4", "a", "c")}
    for n in (1, 5):
        assert {tuple(r) for r in normalize.collapse(df.repartition(n), [RECORD, "x", "y"]).collect()} == want


# --- the cascade ------------------------------------------------------------------------


def test_claimed_rows_meet_no_later_lookup(spark, monkeypatch):
    registry, source = random_case(8)
    people = normalize.index_registry(registry_frame(spark, registry))
    records = cut(normalize.index_source(source_frame(spark, source)))
    seen = []

    def spy(rows, facts, on, how="left"):
        seen.append(({r[RECORD] for r in rows.collect()}, on))
        return attach(rows, facts, on, how)

    attach = matching.attach
    monkeypatch.setattr(matching, "attach", spy)
    steps = {r[RECORD]: r.step for r in matching.tag_steps(records, people).collect()}
    (labs, lab_key), (names, name_key) = seen
    lab_of = {r[RECORD]: r[LAB] for r in records.collect()}
    assert lab_key == ["_lab"] and name_key == ["_kind", "k1", "k2", "k3"]
    assert labs == {r for r, s in steps.items() if s != matching.KNOWN and lab_of[r]}
    assert names <= {r for r, s in steps.items() if s not in (matching.KNOWN, matching.BY_LAB)}
    assert {r for r, s in steps.items() if s in (matching.BY_ADULT, matching.BY_CHILD)} <= names


# --- ranges -----------------------------------------------------------------------------


def test_range_labels_need_no_shuffle(spark, monkeypatch):
    cuts = cut(snapshots.range_boundaries(view(spark, SF, "fx_registry"), ids_per_range=50))
    source = cut(view(spark, SF, "fx_source").select(RECORD))
    found = snapshots.range_of_records(source, cuts)
    assert "Exchange" not in plan_of(found) and "Join" not in plan_of(found)
    assert found.count() == source.count()
    monkeypatch.setattr(snapshots, "MOST_BOUNDS", 3)  # more bounds than a plan may carry: looked back in one order
    other = snapshots.range_of_records(source, cuts)
    assert "Exchange" in plan_of(other)
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, found.collect()))


# --- publishing -------------------------------------------------------------------------


def test_wide_rows_move_once_for_a_payload(spark):
    raw = cut(view(spark, SF, "fx_source_raw").withColumn(ROW, F.monotonically_increasing_id()))
    ids = cut(raw.select(F.col(RECORD)).distinct().withColumn(KEY, F.xxhash64(RECORD)).withColumn("r4_survey_queue_link", F.lit("")))
    mapping = cut(publish.plan_frames(raw, cut(publish.plan_batches(ids))))
    rows = publish.publish_rows(raw, mapping, [], [KEY, RECORD, INSTRUMENT, INSTANCE, "finding"], "now")
    plan = plan_of(publish.framed_lines(publish.payload_lines(rows)))
    # both sides of the one join
    assert plan.count("Exchange hashpartitioning") <= 2 and "rangepartitioning" not in plan


def test_sync_lands_once_and_writes_arrays(spark, tmp_path):
    registry, source = random_case(21)
    base = source_frame(spark, source).withColumn("survey_queue_link", F.lit("l"))
    snapshot = base.unionByName(base.withColumns({INSTRUMENT: F.lit("visit"), INSTANCE: F.lit("1")}))
    flags = spark.createDataFrame([("gone", "1"), ("age", "0")], "field_name string, flag string")
    allowed = [KEY, RECORD, INSTRUMENT, INSTANCE, "first_name", "r4_survey_queue_link", "last_r4_pull"]
    paths = jobs.sync(registry_frame(spark, registry), snapshot, flags, allowed, "now", str(tmp_path), keys_per_batch=7, rows_per_file=10)
    read = {n: spark.read.parquet(p) for n, p in paths.items()}
    batches = {}
    for r in read["batches"].orderBy("batch_id", "place").collect():
        batches.setdefault(r.batch_id, []).append(r.framed)
    parsed = {b: json.loads("".join(x)) for b, x in batches.items()}
    assert {b: len(x) for b, x in parsed.items()} == {r.batch_id: r.n_rows for r in read["receipts"].collect()}
    stages = {r.stage: r.n_rows for r in read["stages"].collect()}
    assert stages["published_rows"] == read["batches"].count() == read["rows"].count()
    assert (stages["mapping"], stages["quarantine"]) == (read["mapping"].count(), read["quarantine"].count())
    assert stages["new_ids"] == read["mapping"].filter("step = 5").count()


def test_sync_of_a_table_read_by_ranges(spark, tmp_path, monkeypatch):
    registry, source = random_case(13)
    table = source_frame(spark, source).withColumn("survey_queue_link", F.lit("l"))
    asked = []

    def read_jdbc(spark_, url, name, predicates, **options):
        asked.append((url, name, predicates, options))
        parts = [table.filter(p) for p in predicates]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole

    monkeypatch.setattr(snapshots, "read_jdbc", read_jdbc)
    allowed = [KEY, RECORD, INSTRUMENT, INSTANCE, "first_name"]
    people = registry_frame(spark, registry)
    odd = f"NOT {RECORD} RLIKE '^[0-9]+$'"
    paths = jobs.sync_database(people, "jdbc:none", "records", [], allowed, "now", str(tmp_path / "a"), tasks=4, unreadable=odd, options={"fetchsize": "9"})
    (url, name, predicates, options), = asked
    assert (url, name, options) == ("jdbc:none", "records", {"fetchsize": "9"}) and 4 <= len(predicates) <= 6
    assert spark.read.parquet(paths["source_in"]).count() == len(source)
    other = jobs.sync(people, table, [], allowed, "now", str(tmp_path / "b"))
    rows = lambda p: sorted(map(tuple, spark.read.parquet(p["mapping"]).collect()))
    assert rows(paths) == rows(other)


# --- counts, skipping, listing ---------------------------------------------------------------


def test_counts_come_with_the_write(spark, tmp_path):
    seen = sinks.write_counted(spark.range(100).withColumn("odd", F.col("id") % 2), str(tmp_path / "t"), odd=F.sum("odd"))
    assert seen == {"n_rows": 100, "odd": 50}
    kept, counts = audit.stored_and_counted({"a": spark.range(7), "b": spark.range(0)})
    assert {r.stage: r.n_rows for r in counts.collect()} == {"a": 7, "b": 0}
    assert kept["a"].count() == 7 and "Range" not in plan_of(counts)


def test_a_landed_lookup_reads_few_rows(spark, tmp_path):
    ids = spark.range(200_000).select(F.col("id").cast("string").alias(RECORD), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    landed = snapshots.land(ids.repartition(8), str(tmp_path / "s"), RECORD, group_bytes=1 << 20)
    assert landed.count() == 200_000 and landed.select(ROW).distinct().count() == 200_000
    one = snapshots.one_record(landed, "777")
    assert [r.x for r in one.collect()] == [r.x for r in ids.filter(f"{RECORD} = '777'").collect()]
    node = one._jdf.queryExecution().executedPlan()
    scan = node.collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() <= 40_000


def test_store_is_listed_without_content(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "m1.json").write_text("{}")
    (tmp_path / "deep" / "g5.pdf").write_bytes(b"12345")
    stored = files.stored_files(spark, str(tmp_path))
    assert {(r.file_name, r.n_bytes) for r in stored.collect()} == {("m1.json", 2), ("g5.pdf", 5)}
    assert "content" not in plan_of(stored)
    asked = spark.createDataFrame([("1", "m1.json", ""), ("2", "m2.json", "g5.pdf")], f"{RECORD} string, a string, b string")
    assert [r.file_name for r in files.pending(asked, stored, ["a", "b"]).collect()] == ["m2.json"]


# --- corrupt input --------------------------------------------------------------------------------


def test_cut_off_exports_are_set_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{RECORD: "1", "x": "y"}, {RECORD: "2", "x": None}]))
    (tmp_path / "b.json").write_text(json.dumps([{RECORD: "3", "x": "y"}])[:-4])
    good, held = snapshots.read_export_parts(spark, str(tmp_path / "*.json"), [RECORD, "x"])
    assert {tuple(r) for r in good.collect()} == {("1", "y"), ("2", "")}
    assert [(r.file[-6:], r.reason) for r in held.collect()] == [("b.json", "unreadable")] and held.first().raw
    with pytest.raises(Exception, match="(?i)malformed"):
        snapshots.read_export(spark, str(tmp_path / "*.json"), [RECORD, "x"]).collect()
    (tmp_path / "l.jsonl").write_text('{"record_id":"1","x":"y"}\n{"record_id":"2",\nnothing\n')
    good, held = snapshots.read_export_parts(spark, str(tmp_path / "l.jsonl"), [RECORD, "x"], lines=True)
    assert good.count() == 1 and {r.raw for r in held.collect()} == {'{"record_id":"2",', "nothing"}


def test_cut_off_uploads_are_set_aside(spark, tmp_path):
    head = "cuimc_id,mrn,last_local,first_local,dob,last_child,child_first,dob_child"
    (tmp_path / "u.csv").write_text(f"{head}\n7,M1,Diaz,Ana,1970-01-01,,,\n8,M2,Ng\n9,M3,\"L, o\",Bo,1980-01-01,,,\n")
    good, held = snapshots.read_intake_parts(spark, str(tmp_path / "u.csv"))
    assert {(r[KEY], r.last_local, r.child_first) for r in good.collect()} == {("7", "Diaz", ""), ("9", "L, o", "")}
    assert [r.raw for r in held.collect()] == ["8,M2,Ng"]


def test_cut_off_lines_that_arrive(spark, tmp_path):
    (day := tmp_path / "in" / "snapshot=2024-01-01").mkdir(parents=True)
    (day / "a.json").write_text('{"record_id":"1","x":"y"}\n{"record_id":"2",\n{"record_id":"3"}\n')
    seen = []
    handle = lambda rows, number: seen.extend((number, r[RECORD], r.x) for r in rows.collect())
    sync_arrivals(spark, str(tmp_path / "in"), [RECORD, "x"], handle, str(tmp_path / "ck"), str(tmp_path / "q"))
    assert sorted(seen) == [(0, "1", "y"), (0, "3", "")]
    assert [(r.raw, r.batch) for r in spark.read.parquet(str(tmp_path / "q")).collect()] == [('{"record_id":"2",', 0)]
    with pytest.raises(Exception, match="(?i)malformed|failed"):
        sync_arrivals(spark, str(tmp_path / "in"), [RECORD, "x"], handle, str(tmp_path / "ck2"))


# --- alerts, dictionaries -----------------------------------------------------------------------------


def surveys(spark, days):
    rows = [(k, "2", "", "2024-01-01", f"l{k}") for k in days]
    return spark.createDataFrame(rows, f"{RECORD} string, previous_survey_complete string, reminder_survey_complete string, run_date string, survey_queue_link string")


def test_a_repeated_run_sends_nothing_twice(spark, tmp_path):
    ledger, none = str(tmp_path / "ledger"), spark.createDataFrame([("9",)], f"{RECORD} string")
    run = lambda day, n, who: {(r[RECORD], r.send_no) for r in jobs.send_alerts(surveys(spark, who), none, ledger, day, n, 7).collect()}
    assert run("2024-01-02", 1, ["1", "2", "9"]) == {("1", 1), ("2", 1)}
    assert run("2024-01-02", 1, ["1", "2", "9"]) == {("1", 1), ("2", 1)}
    assert run("2024-01-09", 2, ["1", "2"]) == {("1", 2), ("2", 2)}
    assert run("2024-01-09", 3, ["1", "3", "3"]) == {("3", 1), ("3", 2)}
    got = sorted((r[RECORD], r.send_no, r.run) for r in spark.read.parquet(ledger).collect())
    assert got == [("1", 1, 1), ("1", 2, 2), ("2", 1, 1), ("2", 2, 2), ("3", 1, 3), ("3", 2, 3)]


def test_alerts_for_arriving_surveys(spark, tmp_path):
    ledger, none = str(tmp_path / "ledger"), spark.createDataFrame([], f"{RECORD} string")
    fields = surveys(spark, []).columns
    send = lambda rows, number: jobs.send_alerts(rows, none, ledger, "2024-01-02", number, 7)
    for day in ("2024-01-02", "2024-01-03"):
        surveys(spark, ["1", "2"]).coalesce(1).write.json(str(tmp_path / "in" / f"snapshot={day}"))
        send_arrivals(spark, str(tmp_path / "in"), fields, send, str(tmp_path / "ck"))
    assert sorted((r[RECORD], r.send_no, r.run) for r in spark.read.parquet(ledger).collect()) == [("1", 1, 0), ("2", 1, 0)]


def test_dictionary_and_reset_jobs(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    paths = jobs.merge_dictionaries(view(spark, d, "fx_dict_registry"), view(spark, d, "fx_dict_source"), view(spark, d, "fx_ignore"), str(tmp_path / "d"))
    merged = spark.read.json(paths["dictionary"])
    assert merged.select("field_name").distinct().count() == merged.count() > 100
    assert spark.read.option("header", True).csv(paths["drift"]).filter("issue = 'ignored_but_gone'").count() > 0
    ledgers = {n: view(spark, d, f"fx_alerts{x}") for n, x in (("alerts", ""), ("sent", "_sent"), ("recurrence", "_recurrence"), ("sent_log", "_sent_log"))}
    paths = jobs.reset_alerts(ledgers, 3, str(tmp_path / "r"))
    size = lambda n: spark.read.parquet(paths[n]).count()
    assert size("sent_removed") + size("sent_kept") == ledgers["sent"].count()
    assert size("sent_log_removed") > 0
    assert alerts.new_sends(spark.createDataFrame([], f"{RECORD} string, send_no int, send_date date"), spark.createDataFrame([], f"{RECORD} string, send_no int, send_date date, run long"), "2024-01-01", 1).count() == 0
