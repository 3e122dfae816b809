"""Pairs that cannot link are left out by the parity of their sets, and no others are."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import jaccard_join
from tests.llm import brute


def variants(n: int = 60, seed: int = 3) -> list[tuple[int, str]]:
    """Texts of one origin with two words of their own each, most of them too unlike to link, and some nearer copies."""
    rnd = random.Random(seed)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(n):
        own = base[:]
        for k in rnd.sample(range(60), 2):
            own[k] = f"own{i}x{k}"
        rows.append((2 * i, " ".join(own)))
        if i % 6 == 0:
            rows.append((2 * i + 1, " ".join([*own, f"end{i}"])))
    return rows


@pytest.mark.parametrize("short", [1000, 2])
def test_few_pairs_are_tested_that_do_not_link(spark, monkeypatch, short):
    tested = []

    def confirmed(pairs, sets, percent, run=jaccard_join.confirmed):
        edges = run(pairs, sets, percent)
        tested.append((pairs.count(), edges.count(), sets.count()))
        return edges

    monkeypatch.setattr(jaccard_join, "SHORT", short)
    monkeypatch.setattr(jaccard_join, "confirmed", confirmed)
    rows = variants()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(table).collect()}
    assert got == brute.components(rows)
    assert jaccard_join.links(table).count() == tested[-1][1]
    pairs, linked, _ = tested[-1]
    assert linked >= 10 and pairs < 4 * linked


def test_parity_never_drops_a_link(spark):
    """Set sizes on both sides of the lengths at which a bitmap doubles, alikeness on both sides of the threshold."""
    rnd = np.random.default_rng(5)
    rows, linked = [], []
    for n in (1, 2, 5, 30, 31, 32, 33, 40, 60, 64, 65, 80, 120, 128, 130, 500, 520, 1100):
        for gone in (0, 0.05, 0.12, 0.14, 0.24, 0.25, 0.3, 0.6, 1.0):
            for more in (0, 0.05, 0.12, 0.33):
                a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
                b = np.unique(np.concatenate((a[int(gone * len(a)) :], rnd.integers(0, 1 << 63, max(int(gone == 1.0), int(more * n))).astype(np.uint64))))
                both = len(np.intersect1d(a, b))
                linked.append(100 * both >= 75 * (len(a) + len(b) - both))
                own = [(len(x), jaccard_join.parity(x).tolist()) for x in (a, b)]
                rows.append((len(rows), *own))
    kind = "struct<n: int, bits: array<bigint>>"
    frame = spark.createDataFrame(rows, f"k int, x {kind}, y {kind}")
    there = {r[0] for r in frame.filter(jaccard_join._alike("x", "y")).select("k").collect()}
    back = {r[0] for r in frame.filter(jaccard_join._alike("y", "x")).select("k").collect()}
    want = {k for k, yes in enumerate(linked) if yes}
    assert there == back and want <= there and len(want) > 100
    assert len(there - want) < 0.3 * (len(rows) - len(want))
