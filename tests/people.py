"""Small random registries and sources, and the linkage rules spelled out in plain loops."""

from __future__ import annotations

import random

from rollcall.schema import (
    INSTANCE,
    INSTRUMENT,
    KEY,
    LAB,
    REGISTRY_MATCH_FIELDS,
    SOURCE_MATCH_FIELDS,
    all_strings,
)

SNAPSHOT_FIELDS = [*SOURCE_MATCH_FIELDS, INSTRUMENT, INSTANCE]


def registry_frame(spark, rows: list[dict]):
    data = [tuple(str(r.get(n, "")) for n in REGISTRY_MATCH_FIELDS) for r in rows]
    return spark.createDataFrame(data, all_strings(REGISTRY_MATCH_FIELDS))


def source_frame(spark, rows: list[dict]):
    data = [
        tuple(None if r.get(n, "") is None else str(r.get(n, "")) for n in SNAPSHOT_FIELDS) for r in rows
    ]
    return spark.createDataFrame(data, all_strings(SNAPSHOT_FIELDS))


def random_case(seed: int, n_registry: int = 40, n_source: int = 60, hot: float = 0.35):
    """Few names, so groups are large; a share ``hot`` of each side has one and the same name."""
    rnd = random.Random(seed)
    pick = lambda xs: rnd.choice(xs)
    firsts, lasts, days = ["ana", "bo", "", "1"], ["diaz", "ng", ""], ["1970-01-01", "1980-02-02", ""]

    def person():
        if rnd.random() < hot:
            return "ana", "diaz", "1970-01-01"
        return pick(firsts), pick(lasts), pick(days)

    registry, source = [], []
    for i in range(n_registry):
        first, last, dob = person()
        child = person() if rnd.random() < 0.3 else ("", "", "")
        registry.append(
            {
                KEY: 100 + i,
                "first_local": first,
                "last_local": last,
                "dob": dob,
                "child_first": child[0],
                "last_child": child[1],
                "dob_child": child[2],
                LAB: pick(["", "", "", "l1", "l2", f"l{i}"]),
                "record_id": str(rnd.randrange(90)) if rnd.random() < 0.3 else "",
            }
        )
    for rid in rnd.sample(range(90), n_source):
        first, last, dob = person()
        child = person() if rnd.random() < 0.5 else ("", "", "")
        source.append(
            {
                "record_id": str(rid),
                "first_name": first,
                "last_name": last,
                "date_of_birth": dob,
                "first_name_child": child[0],
                "last_name_child": child[1],
                "date_of_birth_child": child[2],
                "age": pick(["", "10", "17", "18", "40"]),
                LAB: pick(["", "", "l1", "l2", "l3"]),
                "last_update_timestamp": pick(
                    ["", "2024-01-01 00:00:00", "2024-01-02 00:00:00", f"2024-02-{1 + rid % 28:02d} 10:00:00"]
                ),
            }
        )
    return registry, source


def by_hand(registry: list[dict], source: list[dict]) -> tuple[dict[str, int], dict[int, tuple[str, int]]]:
    """(rule per record, {registry id: (record, rule)}) by pairing everything with everything."""
    age = lambda s: 999 if s["age"] == "" else int(s["age"])
    cased = lambda t: t.upper().isupper()
    own = lambda r: (r["first_local"], r["last_local"], r["dob"])
    kid = lambda r: (r["child_first"], r["last_child"], r["dob_child"])
    tests = [
        lambda s, r: r["record_id"] == s["record_id"],
        lambda s, r: r[LAB] != "" and r[LAB] == s[LAB],
        lambda s, r: age(s) >= 18
        and all(own(r))
        and not cased(r["child_first"])
        and own(r) == (s["first_name"], s["last_name"], s["date_of_birth"]),
        lambda s, r: age(s) < 18
        and all(kid(r))
        and cased(r["child_first"])
        and kid(r) == (s["first_name_child"], s["last_name_child"], s["date_of_birth_child"]),
    ]
    rule: dict[str, int] = {}
    pairs: list[tuple[str, int, int]] = []
    for step, test in enumerate(tests, start=1):
        found = [(s["record_id"], r[KEY]) for s in source if s["record_id"] not in rule for r in registry if test(s, r)]
        for rid, key in found:
            rule[rid] = step
            pairs.append((rid, key, step))
    rest = sorted(s["record_id"] for s in source if s["record_id"] not in rule)
    top = max((r[KEY] for r in registry), default=0)
    for n, rid in enumerate(rest, start=1):
        rule[rid] = 5
        pairs.append((rid, top + n, 5))
    updated = {s["record_id"]: s["last_update_timestamp"] for s in source}
    best: dict[int, tuple[str, int]] = {}
    for rid, key, step in sorted(pairs, key=lambda p: (p[2], p[0])):
        if key not in best or updated[rid] > updated[best[key][0]]:
            best[key] = (rid, step)
    return rule, best
