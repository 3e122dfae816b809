from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from catalog.fixtures import view
from catalog.oracles import oracle_sql
from rollcall.plans import jobs
from rollcall.schema import INSTANCE, INSTRUMENT, KEY, RECORD
from rollcall.sources import sinks, snapshots
from rollcall.streaming.incremental import sync_arrivals
from tests.oracle import connect
from tests.people import SNAPSHOT_FIELDS, by_hand, random_case, registry_frame, source_frame

ALLOWED = [KEY, RECORD, INSTRUMENT, INSTANCE, "first_name", "r4_survey_queue_link", "last_r4_pull"]


def wide(df):
    """Snapshot with a link and one repeat row per record."""
    base = df.withColumn("survey_queue_link", F.concat(F.lit("http://"), RECORD))
    repeat = base.withColumns({INSTRUMENT: F.lit("visit"), INSTANCE: F.lit("1")})
    return base.unionByName(repeat)


def test_sync_writes_mapping_batches_receipts_and_quarantine(spark, tmp_path):
    registry, source = random_case(11)
    _, best = by_hand(registry, source)
    snapshot = wide(source_frame(spark, source))
    paths = jobs.sync(
        registry_frame(spark, registry), snapshot, ["gone"], ALLOWED, "now", str(tmp_path / "out"), keys_per_batch=7
    )
    read = {n: spark.read.parquet(p) for n, p in paths.items()}
    assert {r[KEY]: (r[RECORD], r.step) for r in read["mapping"].collect()} == best

    lines = read["batches"].collect()
    assert len(lines) == 2 * len(best)
    assert all(n == 1 for n in {k: len({r.batch_id for r in lines if r[KEY] == k}) for k in best}.values())
    assert sum(r.n_rows for r in read["receipts"].collect()) == len(lines)
    assert {r.n_keys for r in read["receipts"].filter("batch_id = 1").collect()} == {7}
    body = json.loads(next(r.framed for r in lines if r.instrument == "visit").strip("[,]"))
    assert (body[RECORD], body["last_r4_pull"], set(body)) == ("", "", set(ALLOWED))

    held = {r[RECORD] for r in read["quarantine"].collect()}
    sent = {rid for rid, _ in best.values()}
    assert held | sent == {s["record_id"] for s in source} and not held & sent

    stages = {r.stage: r.n_rows for r in read["stages"].collect()}
    assert (stages["mapping"], stages["published_rows"]) == (len(best), len(lines))


def test_sync_applied_to_the_registry_is_safe_to_repeat(spark, tmp_path):
    registry, source = random_case(5)
    extra = ["first_name", "r4_survey_queue_link", "last_r4_pull", INSTRUMENT, INSTANCE]
    table = registry_frame(spark, registry).withColumns({c: F.lit("") for c in extra})
    snapshot = wide(source_frame(spark, source))
    paths = jobs.sync(table, snapshot, [], ALLOWED, "now", str(tmp_path / "a"), apply=True)
    once = spark.read.parquet(paths["registry"])
    base = once.filter(F.col(INSTRUMENT) == "")
    _, best = by_hand(registry, source)
    linked = {int(r[KEY]): r[RECORD] for r in base.filter("last_r4_pull = 'now'").collect()}
    assert linked == {k: rid for k, (rid, _) in best.items()}
    assert base.count() == len({r[KEY] for r in registry} | set(best))
    again = jobs.apply_rows(once, spark.read.parquet(paths["rows"]))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_sync_of_one_record_and_of_nothing(spark, tmp_path):
    registry, source = random_case(3)
    one = source[0]["record_id"]
    paths = jobs.sync(
        registry_frame(spark, registry), wide(source_frame(spark, source)), [], ALLOWED, "now", str(tmp_path / "a"), record_id=one
    )
    assert {r[RECORD] for r in spark.read.parquet(paths["mapping"]).collect()} == {one}
    with pytest.raises(ValueError, match="empty"):
        jobs.sync(registry_frame(spark, []), source_frame(spark, source), [], ALLOWED, "now", str(tmp_path / "b"))


def test_published_rows_overwrite_their_instances(spark):
    names = [KEY, INSTRUMENT, INSTANCE, "q"]
    make = lambda rows: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    table = make([("1", "", "", "old"), ("1", "v", "1", "keep"), ("2", "", "", "x")])
    rows = make([("1", "", "", ""), ("1", "v", "2", "new")]).withColumn("batch_id", F.lit(1))
    got = {tuple(r) for r in jobs.apply_rows(table, rows).collect()}
    assert got == {("1", "", "", ""), ("1", "v", "1", "keep"), ("1", "v", "2", "new"), ("2", "", "", "x")}


def test_review_intake_and_audit_jobs(spark, tmp_path):
    d = "/root/testdata/sf0.01"
    registry = view(spark, d, "fx_registry").withColumn(KEY, F.col(KEY).cast("string"))
    csv = lambda p: spark.read.option("header", True).csv(p)

    paths = jobs.review_duplicates(registry, str(tmp_path / "dup"))
    sizes = {n: csv(p).count() for n, p in paths.items()}
    # counts agreed between two engines beforehand
    assert sizes["to_delete"] == 147 and sizes["kept"] == 41 + 97 + 101 and sizes["source_linked"] == 101

    paths = jobs.take_in(view(spark, d, "fx_intake"), registry, str(tmp_path / "in"))
    reasons = {r.reason: r["count"] for r in csv(paths["rejected"]).groupBy("reason").count().collect()}
    con = connect(d)
    told = lambda name, what: con.execute(f"SELECT {what} FROM ({oracle_sql()[name]}) q").fetchall()
    each = con.execute(f"SELECT reason, count(*) FROM ({oracle_sql()['intake_rejects']}) q GROUP BY reason").fetchall()
    assert reasons == dict(each)
    assert spark.read.parquet(paths["accepted"]).count() == told("intake_accepted", "count(*)")[0][0]

    paths = jobs.audit_mapping(registry, view(spark, d, "fx_source_snapshot"), str(tmp_path / "audit"))
    assert csv(paths["current_mapping"]).count() == told("match_mapping", "count(*)")[0][0]


def test_crosswalk_jobs(spark, tmp_path):
    registry = spark.createDataFrame([(1, "m1", "", ""), (2, "m2", "", "")], f"{KEY} long, mrn string, cuimc_empi string, provider_npi string")
    pmap = spark.createDataFrame([("e1", "m1", "P")], "empi string, local_pt_id string, facility_code string")
    paths = jobs.fill_enterprise_ids(registry, pmap, str(tmp_path / "e"))
    assert {r[KEY]: r.cuimc_empi for r in spark.read.parquet(paths["registry"]).collect()} == {1: "e1", 2: ""}
    assert spark.read.option("header", True).csv(paths["issues"]).first().status == "not_found"

    named = spark.createDataFrame([(1, "Dr Ana Diaz"), (1, "Bo Ng"), (2, "Cy")], f"{KEY} long, provider_name string")
    npi = spark.createDataFrame([(7, "ana", "diaz"), (8, "bo", "ng")], "npi long, first_name string, last_name string")
    paths = jobs.fill_provider_ids(registry, named, npi, str(tmp_path / "p"))
    assert {r[KEY]: r.provider_npi for r in spark.read.parquet(paths["registry"]).collect()} == {1: "7", 2: ""}


def test_match_checksums_per_step(spark):
    from catalog.queries import QUERIES

    rows = QUERIES["match_mapping"](spark, "/root/testdata/sf0.01")
    total = F.sum(F.col(RECORD).cast("bigint") * 31 + F.col(KEY))
    got = {r.step: (r.n, r.s) for r in rows.groupBy("step").agg(F.count("*").alias("n"), total.alias("s")).collect()}
    sums = f"SELECT step, count(*), sum(CAST(record_id AS BIGINT) * 31 + cuimc_id) FROM ({oracle_sql()['match_mapping']}) q GROUP BY step"
    want = {step: (n, int(t)) for step, n, t in connect("/root/testdata/sf0.01").execute(sums).fetchall()}
    assert got == want and set(want) == {1, 2, 3, 4, 5}


# --- files -----------------------------------------------------------------------------------


def test_exports_and_flags(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps([{"record_id": "1", "a": " X "}, {"record_id": "2", "a": None, "b": 5}]))
    got = snapshots.read_export(spark, str(tmp_path / "e.json"), ["record_id", "a", "b"])
    assert [tuple(r) for r in got.orderBy("record_id").collect()] == [("1", " X ", ""), ("2", "", "5")]
    found = snapshots.read_export(spark, str(tmp_path / "e.json"))
    assert set(found.columns) == {"record_id", "a", "b"} and set(dict(found.dtypes).values()) == {"string"}
    assert snapshots.one_record(got, "2").count() == 1
    assert snapshots.where(got, "a <> ''").count() == 1

    (tmp_path / "i.json").write_text('{"x": 1, "y": 0, "z": "1"}')
    flags = snapshots.read_flags(spark, str(tmp_path / "i.json"))
    assert {r.field_name for r in flags.filter("flag = '1'").collect()} == {"x", "z"}


def test_csv_readers(spark, tmp_path):
    (tmp_path / "up.csv").write_text("mrn,cuimc_id,last_local,first_local,dob,dob_child,last_child,child_first\nM1,7,\"Di, az\",,1970-01-01,,,\n")
    row = snapshots.read_intake(spark, str(tmp_path / "up.csv")).first()
    assert (row[KEY], row.mrn, row.last_local, row.first_local, row.dob_child) == ("7", "M1", "Di, az", "", "")
    (tmp_path / "ids.csv").write_text("note,cuimc_id\na,5\nb,5\nc,x\n")
    assert [r[0] for r in snapshots.read_ids(spark, str(tmp_path / "ids.csv")).collect()] == [5]


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_dictionary_round_trip(spark, tmp_path, kind):
    rows = spark.createDataFrame([(2, "b", "f", "it says \"x\""), (1, "a", "f", "")], "position int, field_name string, form_name string, annotation string")
    sinks.write_dictionary(rows.coalesce(1), str(tmp_path / "d"), kind)
    if kind == "json":
        back = spark.read.json(str(tmp_path / "d"))
    else:
        back = snapshots.read_dictionary(spark, str(tmp_path / "d"), "csv")
        assert "seq" in back.columns
    assert {(r.field_name, r.annotation) for r in back.collect()} == {("a", ""), ("b", 'it says "x"')}


def test_dictionary_order(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"field_name": n, "form_name": "f", "field_annotation": ""} for n in "zya"]))
    got = snapshots.read_dictionary(spark, str(tmp_path / "d.json"))
    assert [r.field_name for r in got.orderBy("seq").collect()] == ["z", "y", "a"]


def test_ranges_cover_every_id(spark):
    ids = [str(i) for i in range(100, 100 + 7 * 23, 7)]
    registry = spark.createDataFrame([(i,) for i in [*ids, *ids, ""]], f"{RECORD} string")
    cuts = snapshots.range_boundaries(registry, ids_per_range=5)
    rows = {r.range_no: (r.lo, r.hi) for r in cuts.collect()}
    assert rows == {0: (100, 135), 1: (135, 170), 2: (170, 205), 3: (205, 240), 4: (240, None)}
    first = ["record_id IS NULL", "record_id < 100", "record_id >= 100 AND record_id < 135"]
    assert snapshots.range_predicates(cuts)[:3] == first
    assert snapshots.range_predicates(cuts)[-1] == "record_id >= 240"
    assert snapshots.range_boundaries(registry, tasks=3).count() == 3
    source = spark.createDataFrame([(i,) for i in ("1", "100", "134", "135", "999", "7", "7", "abc", "", None)], f"{RECORD} string")
    got = sorted(((r[RECORD], r.range_no) for r in snapshots.range_of_records(source, cuts).collect()), key=str)
    want = [("1", -1), ("100", 0), ("134", 0), ("135", 1), ("999", 4), ("7", -1), ("7", -1), ("abc", -2), ("", -2), (None, -2)]
    assert got == sorted(want, key=str)


def test_sorted_report(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "k string, v int")
    sinks.write_report(rows, str(tmp_path / "r"), ["k"])
    files = sorted((tmp_path / "r").glob("part-*.csv"))
    body = [line for f in files for line in f.read_text().splitlines() if line and line != "k,v"]
    assert [b.split(",")[1] for b in body] == ["3", "1", "2"]


# --- arrivals ------------------------------------------------------------------------------------


def test_arrivals_take_the_newest_snapshot_once(spark, tmp_path):
    folder, seen = tmp_path / "in", []

    def drop(day, rows):
        p = folder / f"snapshot={day}"
        p.mkdir(parents=True)
        (p / "part.json").write_text("\n".join(json.dumps({**dict.fromkeys(SNAPSHOT_FIELDS, ""), **r}) for r in rows))

    def handle(batch, number):
        seen.append((number, sorted((r[RECORD], r.first_name, r[INSTANCE]) for r in batch.collect())))

    run = lambda: sync_arrivals(spark, str(folder), SNAPSHOT_FIELDS, handle, str(tmp_path / "ck"))
    drop("2024-01-01", [{"record_id": "1", "first_name": "old"}, {"record_id": "2", "first_name": "two"}])
    drop("2024-01-02", [{"record_id": "1", "first_name": "new"}, {"record_id": "1", "first_name": "new", INSTANCE: "1"}])
    run()
    drop("2024-01-03", [{"record_id": "3", "first_name": "three"}])
    run()
    run()
    assert seen == [
        (0, [("1", "new", ""), ("1", "new", "1"), ("2", "two", "")]),
        (1, [("3", "three", "")]),
    ]


def test_read_ranges_names_unreadable_ids(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "read_jdbc", lambda spark, url, table, predicates, **options: (predicates, options))
    cuts = spark.createDataFrame([(5, 9), (9, None)], "lo long, hi long")
    odd = "record_id LIKE '%x%'"
    got, options = snapshots.read_ranges(spark, "jdbc:none", "t", cuts, unreadable=odd, fetchsize="10")
    own = f"NOT ({odd}) AND record_id"
    assert got == [f"record_id IS NULL OR {odd}", f"{own} < 5", f"{own} >= 5 AND record_id < 9", f"{own} >= 9"]
    assert options == {"fetchsize": "10"}
