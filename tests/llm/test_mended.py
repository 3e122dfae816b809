"""Texts that were lost, crashed or never ended."""

from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from rollcall.llm import cross_parse, decontaminate, exact_dedup, license_scan, nbsvm, piece_viterbi, surrogates
from tests.test_skew import final_plan, splitting  # noqa: F401


def test_long_runs_of_the_space_sign():
    pieces = piece_viterbi._pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("▁" * 100_000, "▁a" * 5_000, "a▁", "▁"):
        assert pieces.decode(np.frombuffer(pieces.encode(text), "<i4").tolist()).decode() == text


def test_text_without_a_gap_ends():
    begun = time.time()
    assert surrogates.mentions("a" * 1_000_000) == surrogates.mentions("a." * 500_000) == []
    (found,) = surrogates.mentions("x" * 200_000 + "@host.example")
    assert found[2] == "email" and time.time() - begun < 20


def test_names_without_their_title():
    text = "Mr John Smith called. Then John Smith left; Smith's car, SMITH again. Johnny and smith stay."
    new, n = surrogates.rewrite(text, {}, b"key")
    assert n == 6 and "Johnny and smith stay." in new
    given, family = new.split()[1:3]
    assert new.split(". ")[1].startswith(f"Then {given} {family} left; {family}'s car, {family.upper()} again")
    assert "John " not in new and "Smith" not in new
    greek = surrogates.mentions("Ο Κύριος Γιωργος Παπας ηρθε")
    assert [(k, e) for _, _, k, e in greek] == [("given-m", "γιωργος"), ("family", "παπας")]


def test_many_given_names_settle_soon(spark):
    rows = spark.range(30_000).select(F.concat(F.lit("Mrs "), F.translate(F.concat(F.lit("A"), F.lpad(F.col("id").cast("string"), 5, "0")), "0123456789", "abcdefghij"), F.lit(" Bolt")).alias("text"))
    found = surrogates.entities(rows, "text", b"k")
    given = found.filter("kind = 'given-f'")
    assert given.count() == 30_000 == given.select("surrogate").distinct().count()
    assert given.agg(F.max("attempt")).first()[0] <= 10


def test_copies_of_an_id_take_one_place(spark):
    one = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.lit("der die das und nicht").alias("text"), F.lit("de").alias("lang"))
    two = spark.createDataFrame([(2, "und ein anderer Text", "de"), (3, "the and of", "en")], "doc_id long, text string, lang string")
    sample = cross_parse.learn(one.union(two))
    assert sample["de"].count("der die das") == 1 and "anderer" in sample["de"] and "the and" in sample["en"]


def plain_scan(scanner, text):
    """Every template at every place."""
    words = license_scan._words(text)
    have = [w for w, _, _ in words]
    found = set()
    for k, want in enumerate(scanner.words):
        size = len(want) + license_scan._room(len(want))
        for i in range(len(have)):
            if have[i] in scanner.sets[k] and (got := scanner.wording(have[i : i + size], k)) is not None:
                found.add((words[i + got[0]][1], k, len(got[2]) + len(got[3])))
    return found


def test_notices_in_long_blocks():
    scanner = license_scan.Scanner()
    for n in (50, 200, 1_000, 5_000, 20_000):
        rnd = random.Random(n)
        for k, (name, notice) in enumerate(license_scan.TEMPLATES):
            if n > 1_000 and k % 9:
                continue
            filler = ["license" if i % 60 == 0 else f"w{rnd.randrange(500)}" for i in range(n)]
            at = rnd.randrange(n)
            text = " ".join([*filler[:at], "x", notice, "x", *filler[at:]])
            found = scanner.scan(text)
            assert [(x[2], x[5], x[6]) for x in found] == [(name, [], [])], (n, notice)
            if n <= 200:
                assert {(x[0], x[3], 0) for x in found} <= plain_scan(scanner, text)


def test_every_place_of_short_texts():
    scanner = license_scan.Scanner()
    rnd = random.Random(5)
    for _ in range(60):
        parts = [rnd.choice([f"w{rnd.randrange(9)}", "license", "all", "not", rnd.choice(license_scan.TEMPLATES)[1]]) for _ in range(30)]
        text = " ".join(parts)
        found, plain = scanner.scan(text), plain_scan(scanner, text)
        assert {(x[0], x[3], len(x[5]) + len(x[6])) for x in found} <= plain
        # what the plain search finds overlaps a statement that was reported
        assert all(any(x[0] <= begin < x[1] or begin <= x[0] < begin + 2000 for x in found) for begin, _, _ in plain)


def test_scores_keep_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "good text here", "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, score string")
    model = nbsvm.fit(docs, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))
    got = nbsvm.score(docs.repartition(2), model)
    assert got.columns == ["doc_id", "text", "score", "score_"]
    rows = {r.doc_id: r for r in got.collect()}
    assert (rows[2].text, rows[2].score, rows[2].score_) == (None, "y", rows[3].score_) and 0 <= rows[1].score_ <= 1


def test_a_hot_text_is_split(splitting):  # noqa: F811
    hot = F.when(F.col("id") % 2 == 0, "the same text everywhere").otherwise(F.concat(F.lit("text "), F.col("id") % 9_000))
    docs = splitting.range(0, 60_000, numPartitions=8).select(F.col("id").alias("doc_id"), hot.alias("text"))
    marked = exact_dedup.mark(docs, exact_dedup.by_range(docs, 3), with_text=False)
    assert "skew=true" in final_plan(marked)
    kept = marked.filter("dedup.kept")
    assert kept.count() == docs.select("text").distinct().count()
    assert kept.filter("dedup.group_size = 30000").first().doc_id == 59_998


def test_items_are_taken_out_of_arrow_batches(spark):
    item = "one two three four five six seven"
    rows = [(1, f"before {item} after", "x"), (2, None, "y"), (3, "nothing of that", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = decontaminate.without_items(docs, spark.createDataFrame([(9, item), (8, None)], "item_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=str) == sorted(rows[1:], key=str)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
