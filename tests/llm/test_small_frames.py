"""Small frames are stored and shuffled by few tasks, whatever the number of shuffle partitions."""

from __future__ import annotations

import numpy as np
import pytest

from rollcall.llm import common
from rollcall.llm.components import stars
from rollcall.llm.set_pairs import confirmed


@pytest.fixture
def dealt(spark):
    """As many partitions as set: adaptive execution joins none of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_are_counted_while_stored(dealt):
    for n in (0, 40):
        found, seen = common.stored(dealt.range(n).repartition(7, "id"))
        assert seen == n == found.count()
    assert common.snug(dealt.range(40).repartition(7, "id")).rdd.getNumPartitions() == 1


def test_narrow_frames_by_their_rows(dealt, monkeypatch):
    monkeypatch.setattr(common, "ROWS", 10)
    found = common.snug(dealt.range(40).repartition(7, "id"))
    assert found.rdd.getNumPartitions() == 4 and {r["id"] for r in found.collect()} == set(range(40))


def test_stars_and_edges_in_few_parts(dealt):
    chain = dealt.createDataFrame([(k, k + 1) for k in range(100, 160)], "u long, v long").repartition(8, "u")
    found = stars(chain)
    assert len(found.inputFiles()) == 1
    assert {tuple(r) for r in found.collect()} == {(k, 100) for k in range(101, 161)}
    sets = dealt.createDataFrame([(k, bytearray(np.arange(20 + k % 2, dtype=np.uint64).tobytes())) for k in range(40)], "cid long, tokens binary")
    pairs = dealt.createDataFrame([(k, k + 1) for k in range(39)], "a long, b long").repartition(8, "a")
    edges = confirmed(pairs, sets, 75)
    assert edges.rdd.getNumPartitions() == 1 and edges.count() == 39
