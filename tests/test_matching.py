from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollcall.operators import matching, normalize
from rollcall.operators.numbering import last_at_or_before, number_rows
from rollcall.schema import INSTANCE, INSTRUMENT, KEY, LAB, RECORD
from tests.people import by_hand, random_case, registry_frame, source_frame


def linked(spark, registry, source, **options):
    reg = normalize.index_registry(registry_frame(spark, registry))
    src = normalize.index_source(source_frame(spark, source))
    rows = matching.link(src, reg, **options).collect()
    out = {r[KEY]: (r[RECORD], r.step) for r in rows}
    assert len(out) == len(rows), "a registry id twice"
    return out


@pytest.mark.parametrize("seed", range(6))
def test_link_equals_pairing_by_hand(spark, seed):
    registry, source = random_case(seed)
    rule, best = by_hand(registry, source)
    reg = normalize.index_registry(registry_frame(spark, registry))
    src = normalize.index_source(source_frame(spark, source))
    tagged = {r[RECORD]: r.step for r in matching.tag_steps(src, reg).collect()}
    assert tagged == rule
    assert linked(spark, registry, source) == best


def test_shared_name_stays_linear(spark):
    """2,000 registry rows and 3,000 records of one name would be six million pairs."""
    same = {"first_local": "ana", "last_local": "diaz", "dob": "1970-01-01"}
    registry = [{KEY: i, **same} for i in range(2000)]
    source = [
        {
            "record_id": str(i),
            "first_name": "Ana ",
            "last_name": "DIAZ",
            "date_of_birth": "1970-01-01",
            "last_update_timestamp": f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}",
        }
        for i in range(3000)
    ]
    reg = normalize.index_registry(registry_frame(spark, registry))
    src = normalize.index_source(source_frame(spark, source))
    winners = matching.rule_winners(matching.tag_steps(src, reg), reg, [matching.BY_ADULT])
    rows = winners.collect()
    assert len(rows) == 2000 and {r[RECORD] for r in rows} == {"2999"} and {r.n_records for r in rows} == {3000}


def person(rid, **more):
    return {"record_id": rid, "last_update_timestamp": "2024-01-01 00:00:00", **more}


def test_forced_match_wins_over_lab(spark):
    registry = [{KEY: 1, "record_id": "7"}, {KEY: 2, LAB: "l"}]
    assert linked(spark, registry, [person("7", **{LAB: "l"})]) == {1: ("7", 1)}


def test_withdrawn_record_vanishes(spark):
    assert linked(spark, [{KEY: 1, "record_id": "7"}], [person("8")]) == {2: ("8", 5)}


def test_blank_times_lose_but_survive(spark):
    registry = [{KEY: 1, LAB: "l"}, {KEY: 2, LAB: "m"}]
    source = [
        person("3", **{LAB: "l", "last_update_timestamp": ""}),
        person("4", **{LAB: "l"}),
        person("5", **{LAB: "m", "last_update_timestamp": ""}),
    ]
    assert linked(spark, registry, source) == {1: ("4", 2), 2: ("5", 2)}


def test_equal_times_take_earlier_rule_then_smaller_record(spark):
    registry = [{KEY: 1, "record_id": "9", LAB: "l"}, {KEY: 2, LAB: "m"}]
    source = [person("10", **{LAB: "l"}), person("9"), person("21", **{LAB: "m"}), person("3", **{LAB: "m"})]
    assert linked(spark, registry, source) == {1: ("9", 1), 2: ("21", 2)}


def test_one_record_on_two_ids(spark):
    registry = [{KEY: 1, "record_id": "7"}, {KEY: 2, "record_id": "7"}]
    assert linked(spark, registry, [person("7")]) == {1: ("7", 1), 2: ("7", 1)}
    both = matching.conflicts(normalize.index_registry(registry_frame(spark, registry))).collect()
    assert sorted((r[RECORD], r[KEY], r.n_ids) for r in both) == [("7", 1, 2), ("7", 2, 2)]


def test_unknown_age_is_adult_and_nan_child_is_none(spark):
    registry = [{KEY: 1, "first_local": "ana", "last_local": "diaz", "dob": "d", "child_first": "NaN"}]
    source = [person("7", first_name=" ANA", last_name="Diaz ", date_of_birth="D", age="")]
    assert linked(spark, registry, source) == {1: ("7", 3)}


def test_blank_keys_never_join(spark):
    registry = [{KEY: 1, "first_local": "ana"}]
    assert linked(spark, registry, [person("7", first_name="ana", age="40")]) == {2: ("7", 5)}


def test_new_ids_follow_text_order_and_respect_reserved_block(spark):
    registry = [{KEY: 5}, {KEY: 10001}]
    source = [person("9"), person("10"), person("100")]
    assert linked(spark, registry, source) == {10002: ("10", 5), 10003: ("100", 5), 10004: ("9", 5)}
    assert linked(spark, registry, source, reserved_from=10000) == {6: ("10", 5), 7: ("100", 5), 8: ("9", 5)}
    with pytest.raises(ValueError, match="reserved"):
        linked(spark, registry, source, reserved_from=8)


def test_empty_registry(spark):
    assert linked(spark, [], [person("7")]) == {1: ("7", 5)}


def test_bad_rows_go_to_quarantine(spark):
    reg = registry_frame(spark, [{KEY: "x1"}, {KEY: " 4 "}])
    assert [r[KEY] for r in normalize.index_registry(reg).collect()] == [4]
    assert [tuple(r) for r in normalize.registry_quarantine(reg).collect()] == [("x1", "bad_key")]
    src = source_frame(spark, [person("1", age="old"), person("2", age="3"), person(" ")])
    assert [r[RECORD] for r in normalize.index_source(src).collect()] == ["2"]
    bad = {(r[RECORD], r.reason) for r in normalize.source_quarantine(src).collect()}
    assert bad == {("1", "bad_age"), ("", "blank_id")}


def test_collapse_takes_first_non_null_in_explicit_order(spark):
    rows = [
        person("1", **{INSTRUMENT: "visit", INSTANCE: "10", "first_name": "ten", "age": "1"}),
        person("1", **{INSTRUMENT: "visit", INSTANCE: "2", "first_name": "two", "age": "2"}),
        person("1", **{"first_name": None, "age": ""}),
        person("2", **{INSTRUMENT: "b", INSTANCE: "1", "first_name": "b"}),
        person("2", **{INSTRUMENT: "a", INSTANCE: "2", "first_name": "a"}),
        person("3", **{INSTRUMENT: "a", INSTANCE: "1", "first_name": "late", "age": "9"}),
        person("3", **{"first_name": "", "age": "8"}),
        person("4", **{"first_name": None, "age": None}),
    ]
    got = {r[RECORD]: (r.first_name, r.age) for r in normalize.collapse(source_frame(spark, rows), [RECORD, "first_name", "age"]).collect()}
    assert got == {"1": ("two", ""), "2": ("a", ""), "3": ("", "8"), "4": (None, None)}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbering_equals_global_window(spark, parts):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("k"))
    want = df.withColumn("w", F.row_number().over(Window.orderBy("k")) + 41)
    got = number_rows(df, ["k"], start=42, parts=parts)
    joined = got.join(want, "k")
    assert joined.count() == 5000 and joined.filter("seq <> w").count() == 0


def test_numbering_of_nothing(spark):
    assert number_rows(spark.range(0).withColumnRenamed("id", "k"), ["k"]).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_look_back_over_range_bounds(spark, parts):
    marks = spark.createDataFrame([(10, 0), (20, 1), (500, 2)], "x long, n long")
    probes = spark.range(0, 1000).select(F.col("id").alias("x"))
    got = {r.x: r.n for r in last_at_or_before(probes, marks, "x", "n", parts).collect()}
    want = {x: None if x < 10 else 0 if x < 20 else 1 if x < 500 else 2 for x in range(1000)}
    assert got == want
