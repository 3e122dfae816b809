"""Conversation repair, importance resampling and SetSketch near copies against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import conversation_repair as repair
from rollcall.llm import importance, set_pairs, setsketch, words
from rollcall.llm.common import utf8
from tests.llm import brute

CONV = "conv long, turn long, role string, text string"

# --- 11 ---------------------------------------------------------------------------------


def first_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        if not ink:
            out.append(1)
        elif (role, text) in seen:
            out.append(2)
        else:
            out.append(3 if ink[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, letters, repaired rows) by searching all edits in the order of cost and letters."""
    faults = first_faults(rows)
    heap = [(0, "", 0, 0, ())]
    done = set()
    while heap:
        cost, letters, i, state, made = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, letters, [f"{r}:{t}" for r, t in made]
        if (i, state) in done:
            continue
        done.add((i, state))
        to = 3 if state == 2 else 2
        heapq.heappush(heap, (cost + 2, letters + "I", i, to, (*made, ({2: "user", 3: "assistant"}[to], ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, state, made))
            if faults[i] not in (1, 2):
                late = int(faults[i] == 3)
                heapq.heappush(heap, (cost + 2 + late, letters + "R", i + 1, to, (*made, ({2: "user", 3: "assistant"}[to], text))))
                own = {"s": 1, "u": 2, "a": 3}.get(role[:1])
                if own == to or own == 1 and state == 0:
                    heapq.heappush(heap, (cost + late, letters + "K", i + 1, own, (*made, (role, text))))


def plain_repair(rows):
    """The row of one conversation (turn, role, text), damaged already."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {t for t, _, _ in rows if t is not None}
    said = [(r, x) for _, r, x in rows]
    faults = first_faults(said)
    cost, letters, made = cheapest(said)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(k) for k in (1, 2, 3)),
        sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])),
        cost,
        letters,
        hashlib.sha256("\n".join(made).encode()).hexdigest(),
    )


def repaired(rows):
    fixed = repair.repair(rows)
    both = fixed.facts.join(repair.digests(fixed.edits), "key")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv"]: tuple(r[n] for n in names) for r in both.collect()}


def random_conversations(seed, n=60):
    rnd = random.Random(seed)
    out = {}
    for c in range(n):
        size = rnd.choice([1, 2, 3, 5, 8, 13, 30, 100]) if c else 700
        role = lambda: rnd.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
        text = lambda: rnd.choice(["a.", "b!", "c", "  ", "", None, "d?\n", "e. x", f"t{rnd.random()}."])
        out[c if c % 7 else -c] = [(rnd.choice([None, *range(size)]), role(), text()) for _ in range(size)]
    return out


def test_repair_is_the_cheapest_and_least(spark):
    told = random_conversations(4)
    told[None] = [(0, "assistant", "x."), (0, "assistant", "x."), (None, "user", "y")]
    frame = spark.createDataFrame([(c, *r) for c, rows in told.items() for r in rows], CONV)
    want = {c: plain_repair(rows) for c, rows in told.items()}
    assert repaired(frame.withColumn("key", F.lit(0)).repartition(5)) == want


def test_repair_of_nothing_and_of_a_hot_conversation(spark):
    assert repaired(spark.createDataFrame([], CONV)) == {}
    rows = [(0, i, "user" if i % 3 else "assistant", f"{i}." if i % 5 else "same.") for i in range(5000)] + [(1, 0, "user", "?"), (1, 1, "assistant", "!")]
    frame = spark.createDataFrame(rows, CONV)
    want = {c: plain_repair([r[1:] for r in rows if r[0] == c]) for c in (0, 1)}
    assert repaired(frame) == want
    fixed = repair.repair(frame)
    coded = repair.codes(repair.placed(frame))
    sizes = repair.blocks(coded, repair.counts(coded)).groupBy("key").agg(F.count("*").alias("n"), F.max(F.size("codes")).alias("m")).collect()
    assert {(r.n, r.m) for r in sizes} == {(math.ceil(5000 / 71), 71), (1, 2)}
    assert fixed.edits.filter("edit <> 'D'").select("key", "block", "place").distinct().count() == fixed.edits.filter("edit <> 'D'").count()


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in (None, 1, 2, 3) for t in (None, *range(30))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("copy", F.lit("x"))
    got = sorted(map(repr, (tuple(r) for r in repair.damage(frame).collect())))
    want = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "One Two"}.get(fate, text)
        want += [(c, t, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    assert got == sorted(map(repr, want))


# --- 12 --------------------------------------------------------------------------------------


def plain_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def plain_resample(docs, target, percent, seed, min_words=20):
    n = importance.BUCKETS
    bucket = lambda f: zlib.crc32(f.encode()) % n
    s, t = np.zeros(n), np.zeros(n)
    for _, x in docs:
        for f in plain_features(x):
            s[bucket(f)] += 1
    for x in target:
        for f in plain_features(x):
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + n) / ((a + 1) * (t.sum() + n)))) for a, b in zip(s, t)]
    out = []
    for i, x in docs:
        fs = plain_features(x)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 2 * min_words - 1), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    drawn = able[: percent * len(able) // 100]
    rest = list(out)
    for r in drawn:
        rest.remove(r)
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in rest], key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("aB9 éж_\n", max_size=300)), max_size=6))
def test_hashed_features(texts):
    own, pairs, _, first = importance.features(*utf8(pa.array(texts, pa.string())))
    plain = [plain_features(t) for t in texts]
    size = [(len(p) + 1) // 2 for p in plain]
    assert list(np.diff(first)) == size
    assert list(own) == [zlib.crc32(f.encode()) % importance.BUCKETS for p, n in zip(plain, size) for f in p[:n]]
    assert list(pairs) == [zlib.crc32(f.encode()) % importance.BUCKETS for p, n in zip(plain, size) for f in p[n:]]


def corpus(seed, n=400):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(50)] + ["x" * 80, "É", "Ω9", "a-b"]
    text = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 19, 20, 25, 60])))
    docs = [(k, text()) for k in range(n)] + [(None, text()), (7, text()), (8, "same " * 30), (8, "same " * 30), (9, None), (10, "")]
    return docs, ["w1 w2 w3 " * 9, None, "w2 w2"]


@pytest.mark.parametrize("width", [1 / 256, 1e-9, 2.0])
def test_resampling(spark, width, monkeypatch):
    docs, target = corpus(3)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("taken")).withColumn("rank", F.lit(1))
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    monkeypatch.setattr(importance.bracket, "__defaults__", (width,))
    monkeypatch.setattr(importance.draw, "__defaults__", (importance.MIN_WORDS, width))
    got = sorted((tuple(r) for r in importance.resample(frame, aim, 25, 7).collect()), key=repr)
    assert got == plain_resample(docs, target, 25, 7)


def test_resampling_bounds_and_ties(spark):
    rows = [(k, 99, 0, 5) for k in range(1000)] + [(2000, 99, 0, 9), (2001, 1, 0, 99)]
    scored = spark.createDataFrame(rows, "id long, n_features long, weight long, score long")
    for percent in (0, 1, 50, 100):
        drawn = importance.draw(scored, percent).filter("rank IS NOT NULL").orderBy("rank").collect()
        assert [r.id for r in drawn] == ([2000, *range(1000)])[: percent * 1001 // 100]
        assert [r["rank"] for r in drawn] == list(range(1, len(drawn) + 1))
    low, high, above = importance.bracket(scored.filter("n_features >= 39"), 500, 1001)
    assert low <= 5 <= high and above == (1 if high < 9 else 0)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(empty, empty, 25, 7).count() == 0


# --- 13 ------------------------------------------------------------------------------------------


def near_copies(seed, groups=8, size=12, length=120):
    """Documents in groups around a centre: most link to the centre, not all to each other."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(100_000)}"
    rows = []
    for g in range(groups):
        centre = [word() for _ in range(length)]
        rows.append(" ".join(centre))
        for _ in range(size):
            own = list(centre)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 4])):
                own[rnd.randrange(length)] = word()
            rows.append(" ".join(own))
    rows += ["", None, "a b", "A B", "a  b\n", "one two three four five", "x"] + [rows[0]] * 40
    ids = list(range(1000, 1000 + len(rows)))
    rnd.shuffle(ids)
    return list(zip(ids, rows))


def plain_components(rows, percent):
    sets = {i: brute.shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_sketched_components(spark):
    rows = near_copies(2)
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(0), "n": F.lit("x"), "key": F.lit(1)})
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in setsketch.components(frame).collect()}
    assert got == plain_components(rows, setsketch.ALIKE)


def test_comparing_alone_finds_the_same(spark, monkeypatch):
    """Without rounds of linking, with small blocks and without broadcasts, every link comes from the blocks."""
    rows = near_copies(5, groups=3)
    monkeypatch.setattr(setsketch, "ROUNDS", 1)
    monkeypatch.setattr(setsketch, "LIKELY", -1.0)
    monkeypatch.setattr(setsketch, "BLOCK", 4)
    monkeypatch.setattr(set_pairs, "FAN", 2)
    monkeypatch.setattr(set_pairs, "BROADCAST_PAIRS", 0)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in setsketch.components(frame).collect()}
    assert got == plain_components(rows, setsketch.ALIKE)


def test_sketch_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert setsketch.components(empty).count() == 0
    rows = [(None, "a b c"), (None, "a b c"), (3, "A b c"), (None, "alone"), (4, None), (4, "")]
    got = sorted(map(repr, (tuple(r) for r in setsketch.components(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    want = [(None, 1, 3, False), (None, 1, 3, False), (3, 1, 3, True), (None, 1, None, False), (4, 0, 4, True), (4, 0, 4, True)]
    assert got == sorted(map(repr, want))


def test_sketches_merge_and_tell_likeness():
    rnd = np.random.default_rng(1)
    for shared, own in ((900, 50), (500, 250), (100, 450)):
        x = words.mix(rnd.integers(0, 1 << 62, shared + 2 * own).astype(np.uint64))
        a, b = np.unique(x[: shared + own]), np.unique(np.concatenate((x[:shared], x[shared + own :])))
        union = np.unique(x)
        sketch = setsketch.registers(np.concatenate((a, b, union)), np.array([0, len(a), len(a) + len(b)]))
        assert (setsketch.merge(sketch[0], sketch[1]) == sketch[2]).all()
        alike = shared / (shared + 2 * own)
        assert abs((sketch[0] == sketch[1]).mean() - alike) < 0.15
        lost = setsketch.doubt(*(np.array([v], float) for v in ((sketch[0] > sketch[1]).sum(), (sketch[0] < sketch[1]).sum(), len(a), len(b))))
        assert (lost[0] <= setsketch.DOUBT) == (alike > 0.7)


def test_likelihood_keeps_pairs_at_the_threshold():
    """Register counts drawn at the threshold, sizes equal and as far apart as they may be."""
    rnd = np.random.default_rng(3)
    for n_a, n_b in ((1000, 1000), (850, 1000)):
        u = n_a / (n_a + n_b)
        p, q = (float(setsketch._tilt(np.array(x))) for x in (u - (1 - u) * 0.85, 1 - u - u * 0.85))
        more, less, _ = rnd.multinomial(setsketch.REGISTERS, [p, q, 1 - p - q], 20_000).T
        lost = setsketch.doubt(more, less, np.full(len(more), float(n_a)), np.full(len(more), float(n_b)))
        assert (lost <= setsketch.DOUBT).all() and (lost <= setsketch.LIKELY).mean() > 0.9
        assert (setsketch.doubt(more, less, np.full(len(more), 800.0), np.full(len(more), 1000.0)) == np.inf).all()
