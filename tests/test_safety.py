"""Nulls, repeats and unreadable keys in imports, deletes, holds and fills."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollcall.operators import audit, crosswalk, normalize, publish, upsert
from rollcall.plans import jobs
from rollcall.schema import INSTANCE, INSTRUMENT, KEY, RECORD

KEYS = [KEY, INSTRUMENT, INSTANCE]


@pytest.mark.parametrize("patch", [False, True])
def test_upsert_null_and_repeated_keys(spark, patch):
    table = spark.createDataFrame([("1", None, None, "old"), ("1", "v", "1", "x")], f"{', '.join(f'{k} string' for k in KEYS)}, a string")
    payload = spark.createDataFrame([("1", "", "", "b"), ("1", "", None, "a"), ("2", None, "", "n")], table.schema)
    got = {tuple(r) for r in upsert.upsert(table, payload, KEYS, patch=patch).collect()}
    assert got == {("1", "", "", "b"), ("1", "v", "1", "x"), ("2", "", "", "n")}


def test_delete_with_text_keys(spark, tmp_path):
    table = spark.createDataFrame([("1", "a"), ("x1", "b"), (" 2 ", "c"), (None, "d"), ("2", "e")], f"{KEY} string, a string")
    ids = spark.createDataFrame([(2,), (2,), (9,)], f"{KEY} long")
    paths = jobs.delete_ids(table, ids, str(tmp_path))
    assert {r.a for r in spark.read.parquet(paths["registry"]).collect()} == {"a", "b", "d"}
    receipt = spark.read.option("header", True).csv(paths["receipt"])
    assert {(r[KEY], r.n_rows) for r in receipt.collect()} == {("2", "2"), ("9", "0")}


def test_every_source_row_is_published_or_held_once(spark):
    rows = [(" R1 ", "", "0", "old age"), ("r1", "v", "1", ""), ("r2", "", "0", "40"), ("r2", "v", "1", ""), ("r3", "", "0", "41"), ("", "", "0", "9"), (None, "v", "1", "")]
    source = spark.createDataFrame(rows, f"{RECORD} string, {INSTRUMENT} string, {INSTANCE} string, age string")
    mapping = spark.createDataFrame([("r2", 5)], f"{RECORD} string, {KEY} long")
    held = publish.held_rows(source, mapping, normalize.source_quarantine(source))
    got = sorted(((r[RECORD] or "", r.reason) for r in held.collect()))
    assert got == [("", "blank_id"), ("", "blank_id"), (" R1 ", "bad_age"), ("r1", "bad_age"), ("r3", "superseded")]


def test_collapse_and_links_do_not_follow_row_order(spark):
    rows = [("1", "", "0", "b", "l2"), ("1", "", "0", "a", "l1"), ("2", "", "0", None, "l3"), ("2", "v", "2", "y", ""), ("2", "v", "1", None, "")]
    schema = f"{RECORD} string, {INSTRUMENT} string, {INSTANCE} string, name string, survey_queue_link string"
    mapping = spark.createDataFrame([("1", 7), ("2", 8)], f"{RECORD} string, {KEY} long")
    for turn in (rows, rows[::-1]):
        source = spark.createDataFrame(turn, schema).coalesce(1)
        got = {r[RECORD]: r.name for r in normalize.collapse(source, [RECORD, "name"]).collect()}
        assert got == {"1": "a", "2": "y"}
        assert sorted(tuple(r) for r in publish.add_links(mapping, source).select(KEY, "r4_survey_queue_link").collect()) == [(7, "l1"), (8, "l3")]


def test_repeat_rows_stay_out_of_fills_and_audits(spark, tmp_path):
    rows = [(1, "", "m1", None, "r1"), (1, "v", "", "", ""), (2, None, None, "", "r9"), (2, "v", "", "", "")]
    registry = spark.createDataFrame(rows, f"{KEY} long, {INSTRUMENT} string, mrn string, cuimc_empi string, {RECORD} string")
    pmap = spark.createDataFrame([("e1", "m1", "P")], "empi string, local_pt_id string, facility_code string")
    paths = jobs.fill_enterprise_ids(registry, pmap, str(tmp_path))
    got = {(r[KEY], r[INSTRUMENT] or "", r.cuimc_empi or "") for r in spark.read.parquet(paths["registry"]).collect()}
    assert got == {(1, "", "e1"), (1, "v", ""), (2, "", ""), (2, "v", "")}
    assert [(r[KEY], r.status) for r in crosswalk.issues(crosswalk.crosswalk(registry, pmap)).collect()] == [(2, "skip_no_mrn")]
    mapping = spark.createDataFrame([("r1", 1), ("r2", 2)], f"{RECORD} string, {KEY} long")
    assert [(r[KEY], r.kind) for r in audit.id_mismatches(mapping, registry).collect()] == [(2, "changed")]


def test_patch_leaves_the_table_in_place(spark):
    table = spark.range(1000).select(F.col("id").alias(KEY), F.lit("x").alias("a"))
    payload = spark.createDataFrame([(1, "y")], f"{KEY} long, a string")
    plan = upsert.upsert(table, payload, patch=True)
    assert plan.filter("a = 'y'").count() == 1 and plan.count() == 1000
