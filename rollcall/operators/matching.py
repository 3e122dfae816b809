"""Record linkage: five ordered rules, new ids, latest record per registry id.

The rules never need the pairs they imply. A source record only has to know which
rule claims it, which is a lookup in the *distinct* keys of the registry; a registry
row only has to know the newest record its key leads to, which is an aggregate of
the source per key. Both joins are against a side that is unique per key, so a name
and birth date shared by a third of all rows on both sides stays linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import all_filled
from rollcall.operators.lookup import attach
from rollcall.operators.normalize import named_child
from rollcall.operators.numbering import number_rows
from rollcall.schema import ADULT_AGE, FOREIGN, FOREIGN_CHILD, KEY, LAB, OWN, OWN_CHILD, RECORD
from rollcall.session import cut

KNOWN, BY_LAB, BY_ADULT, BY_CHILD, NEW = 1, 2, 3, 4, 5
_NAME_KEY = ["k1", "k2", "k3"]
_NEVER = 1 << 62


def _recency() -> Column:
    """Sorts newest first; a record without update time comes last."""
    return F.coalesce(-F.col("updated"), F.lit(_NEVER).cast("bigint"))


def registry_keys(registry: DataFrame) -> DataFrame:
    """Rows (step, k1, k2, k3, key): what a registry row can be found by in rules 2 to 4."""
    entry = lambda step, cols: F.struct(
        F.lit(step).alias("step"), *[c.alias(n) for c, n in zip(cols, _NAME_KEY)]
    )
    names = [F.col(n) for n in OWN]
    child = [F.col(n) for n in OWN_CHILD]
    keys = F.array(
        F.when(F.col(LAB) != "", entry(BY_LAB, [F.col(LAB), F.lit(""), F.lit("")])),
        F.when(all_filled(*names) & ~named_child(), entry(BY_ADULT, names)),
        F.when(all_filled(*child) & named_child(), entry(BY_CHILD, child)),
    )
    return registry.select(KEY, F.inline(F.filter(keys, lambda k: k.isNotNull())))


def known_pairs(registry: DataFrame) -> DataFrame:
    """Rule 1: pairs the registry already holds. One record may sit on several ids."""
    return registry.filter(F.col(RECORD) != "").select(RECORD, KEY).distinct()


def tag_steps(source: DataFrame, registry: DataFrame) -> DataFrame:
    """Source records with the rule that claims them and the key it claims them by.

    A rule sees only what the rules before it left over, and only the rows that can ask it: a claimed row, and one with a blank
    key, is in no later shuffle. What a rule answered is stored, so that the rows it claimed and those it left are read, not
    worked out twice. Looking up a shared name is safe: each side of a lookup is unique per key.
    """
    known = registry.filter(F.col(RECORD) != "").select(RECORD).distinct()
    keys = cut(registry_keys(registry).select("step", *_NAME_KEY).distinct())
    labs = keys.filter(F.col("step") == BY_LAB).select(F.col("k1").alias("_lab"))
    persons = keys.filter(F.col("step") != BY_LAB).select(F.col("step").alias("_kind"), *_NAME_KEY)
    hit = lambda facts: facts.withColumn("_hit", F.lit(True))
    blank = F.lit("")

    adult = F.col("age") >= ADULT_AGE
    own = [F.when(adult, F.col(a)).otherwise(F.col(c)) for a, c in zip(FOREIGN, FOREIGN_CHILD)]
    rows = source.select(
        RECORD,
        "updated",
        F.col(LAB).alias("_lab"),
        F.when(adult, BY_ADULT).otherwise(BY_CHILD).alias("_kind"),
        *[c.alias(n) for c, n in zip(own, _NAME_KEY)],
    )
    by_id = cut(rows.join(hit(known), RECORD, "left"))
    left = by_id.filter("_hit IS NULL").drop("_hit")
    by_lab = cut(attach(left.filter("_lab <> ''"), hit(labs), ["_lab"]))
    left = left.filter("_lab = ''").unionByName(by_lab.filter("_hit IS NULL").drop("_hit"))
    asks = all_filled(*[F.col(n) for n in _NAME_KEY])
    by_name = attach(left.filter(asks), hit(persons), ["_kind", *_NAME_KEY])

    claimed = lambda df, step, *key: df.select(
        RECORD, "updated", step.alias("step"), *[c.alias(n) for c, n in zip([*key, blank, blank, blank], _NAME_KEY)]
    )
    named = F.col("_hit").isNotNull()
    parts = [
        claimed(by_id.filter("_hit"), F.lit(KNOWN)),
        claimed(by_lab.filter("_hit"), F.lit(BY_LAB), F.col("_lab")),
        claimed(
            by_name, F.when(named, F.col("_kind")).otherwise(NEW), *[F.when(named, F.col(n)).otherwise("") for n in _NAME_KEY]
        ),
        claimed(left.filter(~asks), F.lit(NEW)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rule_winners(tagged: DataFrame, registry: DataFrame, steps: list[int]) -> DataFrame:
    """Rules 2 to 4: per registry row and rule the newest record, and how many there were."""
    newest = (
        tagged.filter(F.col("step").isin(steps))
        .groupBy("step", *_NAME_KEY)
        .agg(F.min(F.struct(_recency().alias("recency"), RECORD)).alias("top"), F.count("*").alias("n_records"))
    )
    keys = registry_keys(registry).filter(F.col("step").isin(steps))
    return attach(keys, newest, ["step", *_NAME_KEY], "inner").select(
        KEY, "step", F.col(f"top.{RECORD}").alias(RECORD), F.col("top.recency").alias("recency"), "n_records"
    )


def known_candidates(tagged: DataFrame, registry: DataFrame) -> DataFrame:
    """Rule 1 pairs whose record still exists upstream."""
    live = tagged.filter(F.col("step") == KNOWN)
    return known_pairs(registry).join(live, RECORD).select(
        KEY, "step", RECORD, _recency().alias("recency")
    )


def top_id(registry: DataFrame, reserved_from: int | None = None) -> int:
    """Greatest id in use, below the reserved block if there is one; 0 for an empty registry."""
    ids = registry if reserved_from is None else registry.filter(F.col(KEY) < reserved_from)
    return ids.agg(F.max(KEY)).first()[0] or 0


def new_ids(tagged: DataFrame, registry: DataFrame, reserved_from: int | None = None) -> DataFrame:
    """Rule 5: records nobody claimed get the next free ids, in text order of the record id."""
    rest = tagged.filter(F.col("step") == NEW).select(RECORD)
    start = top_id(registry, reserved_from) + 1
    out = number_rows(rest, [RECORD], KEY, start)
    if reserved_from is not None:
        last = out.agg(F.max(KEY)).first()[0]
        if last is not None and last >= reserved_from:
            raise ValueError(f"new ids {start}..{last} run into the block reserved from {reserved_from}")
    return out.select(RECORD, KEY)


def link(source: DataFrame, registry: DataFrame, reserved_from: int | None = None) -> DataFrame:
    """(record, key, step): the current record of every registry id, old and new.

    Newest update wins; equal times go to the earlier rule, then to the smaller record id.
    Records withdrawn upstream vanish because every candidate comes from the source.
    New ids lie above all old ones, so they need no choice.
    """
    registry = cut(registry)  # five lookups follow, the fields are few
    tagged = cut(tag_steps(source, registry))
    old = known_candidates(tagged, registry).unionByName(
        rule_winners(tagged, registry, [BY_LAB, BY_ADULT, BY_CHILD]).drop("n_records")
    )
    best = old.groupBy(KEY).agg(F.min(F.struct("recency", "step", RECORD)).alias("top"))
    kept = best.select(F.col(f"top.{RECORD}").alias(RECORD), KEY, F.col("top.step").alias("step"))
    return kept.unionByName(new_ids(tagged, registry, reserved_from).withColumn("step", F.lit(NEW)))


def conflicts(registry: DataFrame) -> DataFrame:
    """Records the registry holds under several ids: one row per id, with their number.

    A row per member instead of a list per record: a record on very many ids stays splittable.
    """
    pairs = known_pairs(registry)
    several = pairs.groupBy(RECORD).agg(F.count("*").alias("n_ids")).filter("n_ids > 1")
    return attach(pairs, several, [RECORD], "inner")
