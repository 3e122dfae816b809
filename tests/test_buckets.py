"""A table in key ranges of which an import rewrites only what it touches."""

from __future__ import annotations

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.operators import buckets, numbering, upsert
from rollcall.plans import jobs
from rollcall.schema import INSTANCE, INSTRUMENT, KEY

SCHEMA = f"{KEY} long, mrn string, note string"


def files(path):
    return {d: {f for f in os.listdir(path / "rows" / d) if f.endswith(".parquet")} for d in os.listdir(path / "rows") if d.startswith("bucket=")}


def table(spark, n=1000):
    return spark.range(1, n + 1).select(F.col("id").alias(KEY), F.concat(F.lit("m"), "id").alias("mrn"), F.lit("x").alias("note"))


def test_an_import_rewrites_the_touched_bucket_alone(spark, tmp_path):
    buckets.create(table(spark), str(tmp_path), rows_per_bucket=100)
    before = files(tmp_path)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "rows")).groupBy("bucket").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 120
    payload = spark.createDataFrame([(5, "new", "y"), (7, "", "y")], SCHEMA)
    assert len(named := buckets.merge(spark, str(tmp_path), payload)) == 1
    after = files(tmp_path)
    assert {d for d in before if before[d] != after[d]} == {f"bucket={named[0]}"}
    want = upsert.upsert(table(spark), payload)
    assert sorted(map(tuple, buckets.read(spark, str(tmp_path)).collect())) == sorted(map(tuple, want.collect()))
    buckets.merge(spark, str(tmp_path), payload)  # repeated
    assert sorted(map(tuple, buckets.read(spark, str(tmp_path)).collect())) == sorted(map(tuple, want.collect()))


def test_reading_some_buckets_lists_no_other_folder(spark, tmp_path):
    buckets.create(table(spark), str(tmp_path), rows_per_bucket=100)
    some = buckets.read(spark, str(tmp_path), [3])
    some.collect()
    scan = some._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numPartitions").value() == 1
    ends = buckets.bounds(spark, str(tmp_path))
    got = {r[KEY] for r in buckets.read(spark, str(tmp_path), [3]).collect()}
    assert got == {k for k in range(1, 1001) if sum(e <= k for e in ends) == 3}


def test_deleting_a_whole_bucket_and_keys_out_of_order(spark, tmp_path):
    path = str(tmp_path)
    odd = table(spark, 50).withColumn(KEY, F.col(KEY).cast("string")).union(spark.createDataFrame([("abc", "q", "x"), (None, "r", "x")], "a string, b string, c string"))
    buckets.create(odd, path, rows_per_bucket=10)
    first = [r[KEY] for r in buckets.read(spark, path, [0]).collect()]
    assert buckets.delete(spark, path, spark.createDataFrame([(k,) for k in [*first, "777", "x", None]], f"{KEY} string")) == [0, 4]
    assert "bucket=0" not in files(tmp_path)
    left = {r[KEY] for r in buckets.read(spark, path).collect()}
    assert left == {str(k) for k in range(1, 51)} - set(first) | {"abc", None}
    payload = spark.createDataFrame([("abc", "z", "1"), ("", "s", "2"), ("90", "t", "3"), ("90", "u", "3")], f"{KEY} string, mrn string, note string")
    buckets.merge(spark, path, payload)
    rows = {r[KEY]: r.mrn for r in buckets.read(spark, path).collect()}
    assert (rows["abc"], rows[""], rows["90"]) == ("z", "s", "u")


def test_published_rows_into_a_stored_registry(spark, tmp_path):
    names = [KEY, INSTRUMENT, INSTANCE, "q"]
    make = lambda rows: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    table = make([(str(k), "", "", "old") for k in range(1, 101)] + [("50", "v", "1", "keep"), ("50", "v", "2", "x")])
    path = str(tmp_path / "registry")
    jobs.keep_registry(table, path, rows_per_bucket=20)
    rows = make([("50", "", "", ""), ("50", "v", "2", "new"), ("51", "v", "1", "new"), ("500", "", "", "added")]).withColumns({"batch_id": F.lit(1), "opens": F.lit(True)})
    before = files(tmp_path / "registry")
    named = jobs.import_rows(rows, path)
    after = files(tmp_path / "registry")
    assert {d for d in before if before[d] != after[d]} == {f"bucket={n}" for n in named} and len(named) < len(before)
    want = jobs.apply_rows(table, rows)
    assert sorted(map(tuple, buckets.read(spark, path).collect())) == sorted(map(tuple, want.collect()))
    ids = spark.createDataFrame([("50",), ("7",), ("900",)], f"{KEY} string")
    jobs.remove_ids(ids, path, str(tmp_path))
    assert {r[KEY] for r in buckets.read(spark, path).collect()} == {str(k) for k in range(1, 101)} - {"50", "7"} | {"500"}
    receipt = spark.read.option("header", True).csv(str(tmp_path / "receipt"))
    assert {(r[KEY], r.n_rows) for r in receipt.collect()} == {("50", "3"), ("7", "1"), ("900", "0")}


def test_empty_tables_and_payloads(spark, tmp_path):
    path = str(tmp_path / "a")
    buckets.create(table(spark, 0), path)
    assert buckets.read(spark, path).count() == 0 if os.path.exists(f"{path}/rows/bucket=0") else True
    buckets.create(table(spark, 5), str(tmp_path / "b"))
    assert buckets.merge(spark, str(tmp_path / "b"), table(spark, 0)) == []
    assert buckets.read(spark, str(tmp_path / "b")).count() == 5


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), max_size=20), st.lists(st.one_of(st.none(), st.integers(-60, 60)), max_size=20))
def test_places_among_bounds(spark, bounds, values):
    bounds = sorted(set(bounds))
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    got = [tuple(r) for r in rows.select("v", numbering.place_in(F.col("v"), bounds)).collect()]
    assert got == [(v, None if v is None else sum(b <= v for b in bounds)) for v in values]
