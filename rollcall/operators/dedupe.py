"""Duplicate people inside the registry, and across registry and source.

Group facts are plain aggregates joined back to the members, never a window: a name
and birth date held by a third of the registry combines before the shuffle, and the
join back is against one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.casts import to_age, to_day, to_key
from rollcall.functions.text import all_filled, key_text
from rollcall.operators.lookup import attach
from rollcall.operators.normalize import any_code, normalize_text
from rollcall.schema import ADULT_AGE, DECLINED, FOREIGN, KEY, LAB, OUTCOMES, OWN, OWN_CHILD, RECORD
from rollcall.session import cut

GROUP = ["dob", "first_local", "last_local"]
MEMBER = [*GROUP, "child_first", "last_child", "dob_child", KEY, RECORD, *OUTCOMES]


def index_for_dedupe(snapshot: DataFrame) -> DataFrame:
    """Registry rows with a first name, dates parsed, key as integer."""
    names = [KEY, *OWN, *OWN_CHILD, RECORD, LAB, *OUTCOMES]
    rows = normalize_text(snapshot.select(*names), keep=[KEY])
    rows = rows.withColumns(
        {
            "dob": to_day(F.col("dob")),
            "dob_child": to_day(F.col("dob_child")),
            KEY: to_key(F.col(KEY).cast("string")),
        }
    )
    return rows.filter((F.col("first_local") != "") & F.col(KEY).isNotNull())


def find_duplicates(registry: DataFrame, protect_children: bool = False) -> DataFrame:
    """Rows of every (birth date, first, last) group that spans several registry ids.

    Groups are formed among rows without a child name, then *all* rows with that name and
    date join in, child rows too, unless ``protect_children`` leaves those out. More than
    one id means least and greatest differ, which needs no distinct count.
    """
    parents = registry.filter((F.col("child_first") == "") & F.col("dob").isNotNull())
    groups = (
        parents.groupBy(*GROUP)
        .agg(F.min(KEY).alias("_low"), F.max(KEY).alias("_high"))
        .filter("_low <> _high")
        .select(*GROUP)
    )
    members = parents if protect_children else registry
    return attach(members, groups, GROUP, "inner").select(*MEMBER)


def verdicts(duplicates: DataFrame) -> DataFrame:
    """Members with verdict ``keep_linked``, ``keep_declined``, ``keep_largest`` or ``delete``.

    * An id in a group with any linked member stays, in all its groups.
    * Of the other ids a group with declined ones keeps the largest declined id.
    * A group untouched by that keeps its largest id.

    Verdicts belong to ids, so an id met in two groups gets the same in both; the three
    rules therefore run on (group, id) memberships one after the other. Also carried:
    ``group_linked`` and ``declined`` (id declined and not protected by a link).
    """
    duplicates = cut(duplicates)
    flags = duplicates.groupBy(*GROUP, KEY).agg(
        F.max(F.col(RECORD) != "").alias("linked"),
        F.max(any_code(duplicates, DECLINED, OUTCOMES)).alias("refused"),
    )
    members = cut(flags)
    linked_groups = members.filter("linked").select(*GROUP).distinct()
    linked_ids = attach(members, linked_groups, GROUP, "left_semi").select(KEY).distinct()
    refused_ids = members.filter("refused").select(KEY).distinct().withColumn("declined", F.lit(True))
    free = cut(
        members.join(linked_ids, KEY, "left_anti")
        .join(refused_ids, KEY, "left")
        .select(*GROUP, KEY, F.coalesce("declined", F.lit(False)).alias("declined"))
    )
    refused_groups = free.filter("declined").groupBy(*GROUP).agg(F.max(KEY).alias("_top"))
    settled = attach(free, refused_groups.select(*GROUP), GROUP, "left_semi").select(KEY).distinct()
    open_groups = free.join(settled, KEY, "left_anti").groupBy(*GROUP).agg(F.max(KEY).alias("_top"))
    rank = lambda ids, verdict: ids.select(F.col(ids.columns[-1]).alias(KEY), F.lit(verdict).alias("verdict"))
    keep = (
        rank(linked_ids, "keep_linked")
        .unionByName(rank(refused_groups, "keep_declined"))
        .unionByName(rank(open_groups, "keep_largest"))
        # an id can lead a declined group and an open one; both names keep it
        .groupBy(KEY)
        .agg(F.min("verdict").alias("verdict"))
    )
    refused_free = free.filter("declined").select(KEY).distinct().withColumn("declined", F.lit(True))
    judged = attach(attach(duplicates, keep, [KEY]), refused_free, [KEY])
    return (
        attach(judged, linked_groups.withColumn("group_linked", F.lit(True)), GROUP)
        .select(
            *MEMBER,
            F.coalesce("verdict", F.lit("delete")).alias("verdict"),
            F.coalesce("declined", F.lit(False)).alias("declined"),
            F.coalesce("group_linked", F.lit(False)).alias("group_linked"),
        )
    )


def reports(judged: DataFrame) -> dict[str, DataFrame]:
    """The four review tables."""
    rows = lambda test: judged.filter(test).select(*MEMBER)
    return {
        "declined": rows(F.col("declined")),
        "source_linked": rows(F.col("group_linked")).distinct(),
        "to_delete": rows(F.col("verdict") == "delete"),
        "kept": rows(F.col("verdict") != "delete"),
    }


def cross_source_groups(registry: DataFrame, source: DataFrame) -> DataFrame:
    """People on both sides by birth date, first and last name.

    One row per member with the sizes of its group instead of one row per pair: the pairs
    are the product of a group's two sides, which a shared name would square. ``adult``
    marks registry members of 18 and over (unknown age counts as adult).
    """
    names = [F.col(n) for n in GROUP]
    left = normalize_text(registry.select(KEY, *GROUP, "age"), keep=[KEY, "age"]).filter(F.col("first_local") != "")
    left = left.select(
        *names,
        F.lit("registry").alias("side"),
        F.col(KEY).cast("string").alias("member"),
        F.coalesce(to_age(F.col("age")) >= ADULT_AGE, F.lit(False)).alias("adult"),
    )
    right = source.select(
        *[key_text(F.col(f)).alias(g) for f, g in zip([FOREIGN[2], FOREIGN[1], FOREIGN[0]], GROUP)],
        F.lit("source").alias("side"),
        F.col(RECORD).alias("member"),
        F.lit(False).alias("adult"),
    )
    members = left.unionByName(right).filter(all_filled(*names))
    on = lambda side: F.count(F.when(F.col("side") == side, 1))
    groups = (
        members.groupBy(*GROUP)
        .agg(
            on("registry").alias("n_registry"),
            on("source").alias("n_source"),
            F.count(F.when(F.col("adult"), 1)).alias("n_adult"),
        )
        .filter("n_registry > 0 AND n_source > 0")
    )
    return attach(members, groups, GROUP, "inner")
