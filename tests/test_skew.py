"""Hot keys: the joins that meet them must be split, and pre-aggregates must be partial."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollcall.operators import crosswalk, dedupe, intake, matching, publish
from rollcall.operators.lookup import attach
from rollcall.schema import EMPI, FOREIGN, FOREIGN_CHILD, INTAKE_FIELDS, KEY, LAB, MRN, OUTCOMES, OWN_CHILD, RECORD

ROWS = 60_000

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def splitting(spark):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(c, value, other):
    """One value in a third of the rows, else one per row."""
    return F.when(c % 3 == 0, F.lit(value)).otherwise(other)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def registry(spark):
    i = F.col("id")
    blank = [F.lit("").alias(c) for c in [*OWN_CHILD, LAB, RECORD]]
    return spark.range(0, ROWS, numPartitions=8).select(
        i.alias(KEY),
        hot(i, "ana", i.cast("string")).alias("first_local"),
        hot(i, "diaz", i.cast("string")).alias("last_local"),
        F.lit("1970-01-01").alias("dob"),
        *blank,
    )


def source(spark):
    i = F.col("id")
    return spark.range(0, ROWS, numPartitions=8).select(
        i.cast("string").alias(RECORD),
        hot(i, "ana", i.cast("string")).alias("first_name"),
        hot(i, "diaz", i.cast("string")).alias("last_name"),
        F.lit("1970-01-01").alias("date_of_birth"),
        *[F.lit("").alias(c) for c in FOREIGN_CHILD],
        F.lit("").alias(LAB),
        F.lit(40).alias("age"),
        i.alias("updated"),
    )


def test_tagging_splits_a_hot_name(splitting):
    tagged = matching.tag_steps(source(splitting), registry(splitting))
    assert "skew=true" in final_plan(tagged)
    assert tagged.filter("step <> 3").count() == 0


def test_winners_split_a_hot_name(splitting):
    reg = registry(splitting)
    won = matching.rule_winners(matching.tag_steps(source(splitting), reg), reg, [3])
    assert "skew=true" in final_plan(won)
    top = won.filter("n_records > 1").select(RECORD).distinct().collect()
    assert [r[0] for r in top] == [str(ROWS - 3)] and won.count() == ROWS


def test_blank_labs_do_not_gather(splitting):
    """No source row has a lab id; the rows still spread evenly over the lab shuffle."""
    reg = registry(splitting).withColumn(LAB, F.concat(F.lit("l"), KEY))
    tagged = matching.tag_steps(source(splitting), reg)
    spread = tagged.groupBy("step").count().collect()
    assert {r.step: r["count"] for r in spread} == {3: ROWS}


def test_duplicate_groups_split(splitting):
    reg = registry(splitting).withColumns({c: F.lit("") for c in OUTCOMES}).withColumn("dob", F.to_date("dob"))
    found = dedupe.find_duplicates(reg)
    assert "skew=true" in final_plan(found)
    judged = dedupe.verdicts(found)
    kept = judged.filter("verdict <> 'delete'").select(KEY).collect()
    assert [r[0] for r in kept] == [ROWS - 3] and judged.count() == ROWS // 3


def test_crosswalk_splits_a_hot_number(splitting):
    i = F.col("id")
    reg = splitting.range(0, ROWS, numPartitions=8).select(
        i.alias(KEY), hot(i, "m", F.concat(F.lit("m"), i)).alias(MRN), F.lit("").alias(EMPI)
    )
    pmap = splitting.range(0, ROWS).select(
        F.concat(F.lit("e"), i).alias("empi"), F.concat(F.lit("m"), i).alias("local_pt_id"), F.lit("P").alias("facility_code")
    )
    walked = crosswalk.crosswalk(reg, pmap)
    assert "skew=true" in final_plan(walked)
    assert {r.status: r["count"] for r in walked.groupBy("status").count().collect()} == {
        "filled": ROWS - ROWS // 3,
        "not_found": ROWS // 3,
    }


def test_publishing_splits_a_record_with_very_many_repeats(splitting):
    i = F.col("id")
    wide = splitting.range(0, ROWS, numPartitions=8).select(
        hot(i, "r", i.cast("string")).alias(RECORD),
        F.lit("v").alias("redcap_repeat_instrument"),
        i.cast("string").alias("redcap_repeat_instance"),
        F.sha2(i.cast("string"), 256).alias("q"),
    )
    mapping = splitting.range(0, ROWS).select(
        hot(i, "r", i.cast("string")).alias(RECORD), i.alias(KEY), F.lit("").alias("r4_survey_queue_link")
    ).filter((i == 0) | (i % 3 != 0))
    rows = publish.publish_rows(wide, mapping, [], [KEY, RECORD, "q"], "now")
    assert "skew=true" in final_plan(rows)
    assert rows.count() == ROWS


def test_intake_splits_a_hot_person(splitting):
    i = F.col("id")
    up = splitting.range(0, ROWS, numPartitions=8).select(
        i.cast("string").alias(KEY),
        F.concat(F.lit("n"), i).alias(MRN),
        hot(i, "diaz", i.cast("string")).alias("last_local"),
        F.lit("ana").alias("first_local"),
        F.lit("1970-01-01").alias("dob"),
        *[F.lit("").alias(c) for c in OWN_CHILD],
    )
    known = registry(splitting).withColumn(MRN, F.concat(F.lit("m"), KEY))
    known = known.withColumns({**{c: F.lit("") for c in [*FOREIGN, *FOREIGN_CHILD]}})
    judged = intake.judge(up.select(*INTAKE_FIELDS), known)
    assert "skew=true" in final_plan(judged)
    assert {r.reason: r["count"] for r in judged.groupBy("reason").count().collect()} == {
        None: ROWS - ROWS // 3,
        "known_person": ROWS // 3,
    }


def test_attach_is_a_plain_join(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 1, "z")], "k string, n int, v string")
    facts = spark.createDataFrame([("a", 1, 10)], "k string, n int, w int")
    assert sorted(map(tuple, attach(rows, facts, ["k", "n"]).select("k", "n", "v", "w").collect())) == [
        ("a", 1, "x", 10),
        ("a", 1, "z", 10),
        ("b", 2, "y", None),
    ]
    assert attach(rows, facts, ["k", "n"], "inner").count() == 2
    assert attach(rows, facts.select("k", "n"), ["k", "n"], "left_semi").columns == ["k", "n", "v"]
