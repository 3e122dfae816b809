"""Corpus operators against brute force, exact round trips and odd tables."""

from __future__ import annotations

import random
import re
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

import corpus_pipeline
from rollcall.llm import (
    bitplanes,
    chat_grammar,
    cross_parse,
    decontaminate,
    exact_dedup,
    fuse,
    jaccard_join,
    license_scan,
    nbsvm,
    piece_viterbi,
    screen,
    surrogates,
    words,
)
from rollcall.llm.common import utf8
from tests.llm import brute

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Columns of documents, and two that clash with helper names.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, dedup string, _KEY string"


def vocabulary(n: int = 300) -> list[str]:
    r = random.Random(3)
    return ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n)]


def sentence(r: random.Random, n: int) -> str:
    v = vocabulary()
    return " ".join(r.choice(v) for _ in range(n))


def edited(r: random.Random, text: str, times: int) -> str:
    w = text.split(" ")
    for _ in range(times):
        w[r.randrange(len(w))] = r.choice(vocabulary())
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    """Near copies around the threshold, exact copies, nulls, empties, short texts, repeats, a long text."""
    r = random.Random(11)
    base = [sentence(r, n) for n in (40, 60, 120, 25)]
    texts = [sentence(r, r.randint(1, 80)) for _ in range(40)]
    texts += [edited(r, b, k) for b in base for k in (0, 1, 1, 2, 2, 3, 4, 6) for _ in range(4)]
    texts += [base[0]] * 6 + [base[1].upper(), None, None, "", "", "  ", "one two", "One  two", "a b c d", sentence(r, 30_000)]
    out = [(i, t) for i, t in enumerate(texts)]
    return [*out, (None, base[0]), (None, "nobody knows this one text"), (7, out[7][1])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, "en" if t else None, None, len(t or ""), "x", None) for i, t in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


# --- words and filters ----------------------------------------------------------------


def test_words_in_slices(monkeypatch):
    texts = ["a B\tc d e f", "", None, "ñandú Ñ y\x0bz", "hello hello", " x"]
    monkeypatch.setattr(words, "SLICE_BYTES", 8)
    hashes, first = words.words(*utf8(pa.array(texts).slice(0)))
    seen: dict = {}
    for i, t in enumerate(texts):
        own = brute.words(t)
        assert first[i + 1] - first[i] == len(own)
        for k, w in enumerate(own):
            assert seen.setdefault(w, hashes[first[i] + k]) == hashes[first[i] + k]
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("n", [0, 1, 3, 1000, 70_000])
def test_fuse_filter(n):
    draw = np.random.default_rng(n)
    keys = draw.integers(0, 1 << 63, n).astype(np.uint64)
    made = fuse.build(np.concatenate([keys, keys[:2]]))
    assert fuse.might_hold(keys, *made).all()
    assert fuse.might_hold(draw.integers(0, 1 << 63, 20_000).astype(np.uint64), *made).mean() < 0.01


# --- 1 --------------------------------------------------------------------------------


def test_decontaminate_brute(spark, docs, rows):
    r = random.Random(2)
    texts = [t for _, t in rows if t]
    items = [(1, " ".join(texts[45].split()[:20])), (2, sentence(r, 20)), (3, None), (4, ""), (5, "one two"), (6, " ".join(texts[-4].split()[20_000:20_030]))]
    items += [(7, edited(r, " ".join(texts[60].split()[5:35]), 1)), (8, texts[70]), (8, texts[70]), (None, texts[60])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(decontaminate.matches(docs, table).collect(), key=str)
    want, clean = [], []
    for i, t in rows:
        held = len(want)
        for j, x in items:
            width = min(5, len(brute.words(x)))
            own = brute.shingles(x, width) if width else set()
            shared = len(own & brute.shingles(t, width)) if own else 0
            if own and 4 * shared >= 3 * len(own):
                want.append((i, j, len(own), shared))
        if held == len(want):
            clean.append((i, t))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    left = decontaminate.without_items(docs, table)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(clean, key=str)


def test_decontaminate_empty(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(docs, none).count() == 0
    assert decontaminate.without_items(docs, none).count() == docs.count()
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.matches(empty, some).count() == 0


# --- 2 --------------------------------------------------------------------------------

SAID = (
    "Mail John.Doe7@mail3.Example.com, john.doe7@MAIL3.example.com; Mr. John Smith, Mrs Anna Smith, Mr. Smith, Господин Иван Петров "
    "at +1 (017) 555-7713, 97.51.17.173, 4111 1111 1111 1111 on 2024-01-02. token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""
)


def test_surrogates(spark):
    many = [f"from user{i}@mail.example.com and {i // 250}.{i % 250}.3.4 to Mr. Jo Bo{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(600)]
    table = spark.createDataFrame([(0, SAID), (1, SAID), (2, None), (3, ""), (4, "nothing 12 here"), *enumerate(many, 5)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in surrogates.replace(table.repartition(3), b"key").collect()}
    assert out[0]["text"] == out[1]["text"] and out[0]["n_replaced"] == 13
    assert out[2]["text"] is None and out[3]["text"] == "" and out[4]["text"] == "nothing 12 here"
    assert "2024-01-02" in out[0]["text"]
    for said in ("ohn", "Smith", "Иван", "7713", "97.51", "4111", "04dbeb"):
        assert said not in out[0]["text"]
    was, now = ([(k, e) for _, _, k, e in surrogates.mentions(t)] for t in (SAID, out[0]["text"]))
    assert [k for k, _ in was] == [k for k, _ in now]
    assert len(set(was)) == len(set(now)) and dict(zip(was, now, strict=True)).keys() == set(was)
    assert surrogates._luhn(dict(now)["card"])
    found = surrogates.entities(table, "text", b"key").collect()
    real = {(r["kind"], r["entity"]) for r in found}
    new = [(r["kind"], r["surrogate"]) for r in found]
    assert len(set(new)) == len(new) and not real & set(new)


def test_surrogates_without_broadcast(spark, monkeypatch):
    texts = [(i, f"Mr. A{chr(97 + i % 26)}{chr(97 + i // 26)}o and a{chr(97 + i % 26)}@x.org") for i in range(500)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    one = {tuple(r) for r in surrogates.replace(table, b"k").collect()}
    monkeypatch.setattr(surrogates, "BROADCAST_ENTITIES", -1)
    assert {tuple(r) for r in surrogates.replace(table, b"k").collect()} == one


def test_permutation():
    assert sorted(surrogates.permute(i, 777, b"k", "t") for i in range(777)) == list(range(777))


# --- 3 --------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [screen.BROADCAST_BYTES, 0])
def test_exact_dedup_brute(docs, rows, most):
    marked = exact_dedup.mark(docs, exact_dedup.by_range(docs, 3), broadcast_bytes=most)
    assert marked.columns[:-1] == docs.columns
    got = [(r["doc_id"], r["text"], r[-1]) for r in marked.collect()]
    assert len(got) == len(rows)
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    for i, t, d in got:
        own = groups[t or ""]
        assert d["group_size"] == len(own)
        assert d["keep_id"] == max((x for x in own if x is not None), default=None)
    kept = [t or "" for _, t, d in got if d["kept"]]
    assert sorted(kept) == sorted(groups)


def test_exact_dedup_parts_equal_digests(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "digest", lambda c: F.unhex(F.lpad(F.hex(F.length(F.coalesce(c, F.lit("")))), 64, "0")))
    assert exact_dedup.keep_one(docs, F.lit(0)).count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_exact_dedup_empty(empty):
    assert exact_dedup.keep_one(empty, exact_dedup.by_range(empty, 3)).columns == empty.columns


# --- 4 --------------------------------------------------------------------------------


def test_cross_parsing_counts_longest_matches():
    parser = cross_parse.Parser({"x": "abcabd", "y": "bcbcbc"})
    found, symbols, letters = parser.phrases(["abcabcabd", "ABC!! abd", "", "12 3", "zzz"])

    def phrases(text, sample):
        n = at = 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in sample:
                size += 1
            n, at = n + 1, at + size
        return n

    for i, t in enumerate(("abcabcabd", "abc abd", "", None, "zzz")):
        if t is not None:
            assert found[i].tolist() == [phrases(t, "abcabd"), phrases(t, "bcbcbc")]
    assert letters.tolist() == [True, True, False, False, True]


def test_language_odd_tables(spark, docs, empty):
    sample = cross_parse.learn(docs)
    assert list(sample) == ["en"]
    got = cross_parse.predict(docs, sample)
    assert {r["language"]["lang"] for r in got.filter("trim(coalesce(text, '')) = ''").collect()} == {"und"}
    assert cross_parse.learn(empty) == {}
    assert cross_parse.predict(docs, {}).filter("language.lang <> 'und'").count() == 0


def test_language_held_out(spark):
    from rollcall.llm.catalog import op4_cross_parse

    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = op4_cross_parse(spark, sf).filter("held_out").join(truth, "doc_id")
    right = held.filter("lang_pred = lang").count()
    assert right >= 0.97 * held.count()


# --- 5 --------------------------------------------------------------------------------


def test_license_scan(spark):
    mit = license_scan.TEMPLATES[2][1]
    texts = [
        "Foo bar.\nLicensed under CC BY-NC 4.0. All rights reserved.\nzz",
        "Licensed under the Apache Licence, Version 2.0.\nLicensed under the Apache License, Version 1.1.",
        f"Copyright 2020 X\n{mit.replace('Software', 'Program')}",
        "This is not licensed at all",
        None,
        "",
        "Released under the MIT License.\n" * 50,
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got: dict = {}
    for r in license_scan.scan(table).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [r["license"] for r in got[0]] == ["CC-BY-NC-4.0", "proprietary"]
    assert [r["license"] for r in got[1]] == ["Apache-2.0"] and got[1][0]["missing"] == ["license"]
    assert [r["license"] for r in got[2]] == ["MIT"]
    assert set(got) == {0, 1, 2, 6} and len(got[6]) == 50
    r = got[0][0]
    assert texts[0][r["start"] : r["start"] + r["length"]] == "Licensed under CC BY-NC 4.0."


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_wrapped_notices(mark):
    scanner = license_scan.Scanner()
    for name in ("MIT", "BSD", "GPL-3.0"):
        notice = max((t for n, t in license_scan.TEMPLATES if n == name), key=len)
        for width in (40, 72, 80):
            wrapped = "\n".join(mark + x for x in textwrap.wrap(notice, width))
            found = scanner.scan(f"{mark}Some words before.\n{mark}\n{wrapped}\n{mark}\n{mark}And some after.\n")
            assert [(x[2], x[5], x[6]) for x in found] == [(name, [], [])]
    both = [max((t for n, t in license_scan.TEMPLATES if n == name), key=len) for name in ("BSD", "MIT", "BSD")]
    assert [x[2] for x in scanner.scan("\n\n".join(mark + textwrap.fill(x, 60) for x in both))] == ["BSD", "MIT", "BSD"]


def test_license_tags():
    for tag, name in (("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-3.0-or-later", "GPL-3.0"), ("MIT-0", "MIT-0"), ("BSD-3-Clause", "BSD")):
        assert [x[2] for x in license_scan.Scanner().scan(f"// SPDX-License-Identifier: {tag}\nint x;\n")] == [name]
    assert license_scan.Scanner().scan("SPDX-License-Identifier: MIT-Modern-Variant") == []


def test_short_notices_without_full_stop():
    scanner = license_scan.Scanner()
    for k, (name, notice) in enumerate(license_scan.TEMPLATES):
        bare = notice.rstrip(".")
        if len(bare.split()) > 8:
            continue
        for text in (bare, f"# {bare}\nText", f"(c) 2020 Someone, {bare} and so on, as the page says"):
            found = scanner.scan(text)
            assert [(x[2], x[3]) for x in found] == [(name, k)]
            assert text[found[0][0] : found[0][1]] == bare


# --- 6 --------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", [bitplanes.BYTE, bitplanes.BIT])
def test_planes(kind):
    for n in (0, 1, 7, 8, 9, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << 32, n).astype(np.uint32)
        assert (bitplanes.unpack(bitplanes.pack(ids, kind)) == ids).all()
    damaged = bytearray(bitplanes.pack(np.arange(9, dtype=np.uint32), kind))
    damaged[12] ^= 1
    with pytest.raises(ValueError):
        bitplanes.unpack(bytes(damaged))


def test_encoder_agrees_with_whole_texts(rows):
    odd = ["A,b.C!! x<|ENDOFTEXT|>, É. Été, İ. Ǩ! 12,3. don't? ...,, a_, á, IT'S. x²,", "á b\x1cc d ́x", "Σας ΟΔΟΣ", "<|endoftext|> y", "日本語 テ", "x\x85y", " \n"]
    texts = [t for _, t in rows if t] + odd
    cut = bitplanes.Encoder(BPE)
    assert cut.direct
    assert cut.encode(texts) == bitplanes.Encoder(BPE, split=False).encode(texts)


def test_token_files(spark, docs, rows, empty, tmp_path):
    path = str(tmp_path / "ids")
    bitplanes.write(docs, path, BPE, parts=3, block=64)
    encoder = bitplanes.Encoder(BPE, split=False)
    digests = {}
    at = 0
    order = sorted(bitplanes.digests(spark, path).collect(), key=lambda r: r["start"])
    assert len(order) == len(rows)
    assert [r["doc_id"] is None for r in order[:2]] == [True, True]
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]
        digests.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    for i, t in rows:
        raw = encoder.encode([t or ""])[0] + (1).to_bytes(4, "little")
        assert (len(raw) // 4, zlib.crc32(raw)) in digests[i]
    back = {r["start"]: r["ids"] for r in bitplanes.read(spark, path).collect()}
    assert all(len(back[r["start"]]) == r["n_tokens"] for r in order)
    bitplanes.write(empty, str(tmp_path / "none"), BPE, parts=2)
    assert bitplanes.digests(spark, str(tmp_path / "none")).count() == 0


# --- 7 --------------------------------------------------------------------------------


def best_score(p: piece_viterbi.Pieces, scores: dict[str, float], text: str) -> float:
    """Plain dynamic program over all pieces that begin at each position."""
    text = text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 32) + 1):
            if (s := scores.get(text[i:j])) is not None:
                best[j] = max(best[j], best[i] + s)
        if text[i] not in scores:
            best[i + 1] = max(best[i + 1], best[i] + p.lowest)
    return best[-1]


def test_viterbi_is_best(rows):
    p = piece_viterbi.Pieces(PIECES)
    scores = {w: v[1] for w, v in p.automaton.items()}
    by_id = {v[2]: v[1] for v in p.automaton.values()}
    for t in [t for _, t in rows if t][:30] + ["  a  b \n\n c", "日本🎉語 x", "\t tab", "a" * 50, " "]:
        whole = p.best_path(f" {t}")
        ids = np.frombuffer(p.encode(t), "<i4").tolist()
        assert ids == whole
        unknown = sum(1 for c in t.replace(" ", "▁") if c not in p.single)
        total = sum(by_id.get(i, 0.0) for i in ids) + unknown * p.lowest
        assert total == pytest.approx(best_score(p, scores, f" {t}"), abs=1e-3)


def test_ids_equal_the_library(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    odd = ["international government", "  a  b \n\n c" + " " * 40, "日本🎉語 x", "\t tab\r\n", "a" * 500, " ", "<s> </s> <0x41> <unk>", "é e\u0301 \x00\x07", "ลักษณะ" * 9, "ลักษณะ" * 90, "international" * 40]
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    whole = docs.select("doc_id", "text").union(more).union(given)
    texts = {(r["doc_id"], tuple(library.encode(r["text"] or ""))) for r in whole.collect()}
    assert texts == {(r["doc_id"], tuple(r["ids"])) for r in piece_viterbi.encode(whole, PIECES).collect()}


def test_kind_of_model(tmp_path):
    assert type(piece_viterbi._pieces(PIECES)) is piece_viterbi.Merges
    model = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    (tmp_path / "unigram.model").write_bytes(model.SerializeToString())
    assert type(piece_viterbi._pieces(str(tmp_path / "unigram.model"))) is piece_viterbi.Pieces


def test_pieces_round_trip(spark, docs, rows, empty):
    more = spark.createDataFrame([(9001, "x▁y ▁"), (9002, "  two  \n\n\t🎉")], "doc_id long, text string")
    got = piece_viterbi.encode(docs.select("doc_id", "text").union(more), PIECES)
    assert got.filter("NOT round_trip").count() == 0
    texts = {(r["doc_id"], r["text"]) for r in piece_viterbi.decode(got, PIECES).collect()}
    assert {(i, t or "") for i, t in rows} | {(9001, "x▁y ▁"), (9002, "  two  \n\n\t🎉")} == texts
    assert piece_viterbi.encode(empty, PIECES).count() == 0


# --- 8 --------------------------------------------------------------------------------


def test_quality_held_out(spark):
    from rollcall.llm.catalog import op8_quality_nbsvm

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = op8_quality_nbsvm(spark, sf).filter("held_out").join(labels, "doc_id")
    assert held.filter("predicted = quality").count() >= 0.9 * held.count()
    assert held.filter("quality = 1 AND predicted = 1").count() >= 0.98 * held.filter("quality = 1").count()


def test_descent_reaches_the_optimum():
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 30, 8)) for _ in range(60)]
    y = np.where(draw.random(60) < 0.5, 1.0, -1.0)
    ratio, cost = draw.normal(size=30), np.full(60, 0.7)
    w, b = nbsvm.descend(rows, y, ratio, cost)

    def loss(w, b):
        x = np.zeros((60, 30))
        for i, r in enumerate(rows):
            x[i, r] = ratio[r] / np.sqrt(len(r))
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - y * (x @ w + b))).sum()

    at = loss(w, b)
    for _ in range(200):
        assert at <= loss(w + 0.05 * draw.normal(size=30), b + 0.05 * draw.normal()) + 1e-2


def test_quality_odd_tables(spark, docs, empty):
    schema = T.StructType.fromDDL("doc_id long, quality int")
    none = nbsvm.fit(docs, spark.createDataFrame([], schema))
    assert {r["score"] for r in nbsvm.score(docs, none).collect()} == {0.5}
    some = [(None, 1), (1, None), (2, 1), (2, 1), (3, 1)]
    one = nbsvm.fit(docs, spark.createDataFrame(some, schema))
    assert nbsvm.score(docs, one).filter("abs(score - 0.75) > 1e-9").count() == 0
    both = nbsvm.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(30)], schema))
    assert nbsvm.score(docs, both).filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert nbsvm.score(empty, both).count() == 0


# --- 9 --------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "\\", "a\\b", "\\\\</s>", "[ROLE:", "<\\s>", "<s", "s>", "", None, "x\n y", "[/ANS]</s><s>[INST] no", " [/INST]"]
    roles = ["user", "assistant", "system", "tool]</s>", None, "", "INST"]
    turns = [(c, k, roles[(c + k) % 7], hard[(c * 3 + k) % len(hard)]) for c in range(40) for k in range(5)]
    turns += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (3, 1, "user", "tie"), (3, 1, "user", "tie")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    out = {r["conv_id"]: r for r in chat_grammar.format_conversations(table).withColumn("turns", chat_grammar.parse(F.col("formatted"))).collect()}
    want: dict = {}
    for c, k, role, text in turns:
        want.setdefault(c, []).append((k is not None, k or 0, role or "", text or ""))
    assert set(out) == set(want)
    for c, told in want.items():
        assert [(t["role"], t["text"]) for t in out[c]["turns"]] == [x[2:] for x in sorted(told)]
    mask = chat_grammar.loss_mask(spark.createDataFrame([(c, r["formatted"]) for c, r in out.items() if c is not None], "conv_id long, formatted string"))
    masked: dict = {}
    for m in sorted(mask.collect(), key=lambda m: (m["conv_id"], m["turn_no"])):
        body = out[m["conv_id"]]["formatted"][m["start"] : m["start"] + m["length"]]
        masked.setdefault(m["conv_id"], []).append(re.sub(r"(?s)\\(.)", r"\1", body))
    said = {c: [x[3] for x in sorted(told) if x[2] == "assistant"] for c, told in want.items() if c is not None}
    assert masked == {c: texts for c, texts in said.items() if texts}
    assert chat_grammar.format_conversations(table.limit(0)).count() == 0


# --- 10 -------------------------------------------------------------------------------


def test_jaccard_brute(spark, docs, rows, monkeypatch):
    plain = [(i, t) for i, t in rows if i is not None]
    want = brute.components([*dict(plain).items()])
    table = docs.filter("doc_id IS NOT NULL")
    for short, block in ((8, 1024), (1, 2)):
        monkeypatch.setattr(jaccard_join, "SHORT", short)
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        got = jaccard_join.components(table).collect()
        assert len(got) == len(plain)
        assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


@pytest.mark.parametrize("short, block", [(8, 1024), (2, 4)])
def test_all_links(spark, rows, monkeypatch, short, block):
    monkeypatch.setattr(jaccard_join, "SHORT", short)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = [t for _, t in rows] + [f"{sentence(random.Random(5), 60)} {x}" for x in range(20)]
    sets = [frozenset(brute.shingles(t)) for t in texts]
    first = {s: sets.index(s) for s in sets if s}
    link = {(a, b) for a in first for b in first if first[a] < first[b] and 100 * len(a & b) >= 75 * len(a | b)}
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard_join.links(table).collect()
    assert len(got) == len(link) > 190 and {(r["id_a"], r["id_b"]) for r in got} == {(first[a], first[b]) for a, b in link}
    each = {i: sum(k != i and bool(t) and (t == s or (s, t) in link or (t, s) in link) for k, t in enumerate(sets)) for i, s in enumerate(sets)}
    assert {r["id"]: r["n_links"] for r in jaccard_join.link_counts(table).collect()} == each


def test_keep_one(docs, rows, empty):
    left = jaccard_join.keep_one(docs)
    assert left.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    full = [(i if i is not None else -1, t) for i, t in rows]
    named = brute.components(list(enumerate(t for _, t in full)))
    want: dict = {}
    for k, (i, t) in enumerate(full):
        if named[k][0]:
            want.setdefault(named[k][1], []).append(i)
    assert sorted(-1 if i is None else i for i, t in got if brute.words(t)) == sorted(min(v) for v in want.values())
    assert sum(not brute.words(t) for _, t in got) == sum(not brute.words(t) for _, t in rows)
    assert jaccard_join.keep_one(empty).count() == 0
    assert jaccard_join.components(empty).count() == 0


# --- pipeline -------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    items = [brute.shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        new = spark.read.parquet(str(tmp_path / str(k)))
        before, after = docs.collect(), new.collect()
        if name == "exact dedup":
            most: dict = {}
            for r in before:
                most[r["text"]] = max(r["doc_id"], most.get(r["text"], -1))
            assert sorted(r["doc_id"] for r in after) == sorted(most.values())
        elif name == "n-gram Jaccard join":
            named = brute.components([(r["doc_id"], r["text"]) for r in before])
            assert {r["doc_id"] for r in after} == {c for _, c in named.values()}
        elif name == "benchmark decontamination":
            clean = [r["doc_id"] for r in before if not any(4 * len(i & brute.shingles(r["text"])) >= 3 * len(i) for i in items)]
            assert sorted(r["doc_id"] for r in after) == sorted(clean)
        if k < 4:
            assert new.columns == columns
        docs = new
    assert docs.filter("NOT round_trip").count() == 0 and docs.count() > 0


def test_pipeline_rereads_each_stage(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    files = out.inputFiles()
    assert files and all(f"/{len(corpus_pipeline.STAGES) - 1}/part-" in f for f in files)
    path = files[0].rsplit("/", 2)[0]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    scored = nbsvm.score(docs, nbsvm.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()
    rejected = {r["doc_id"] for r in scored if r["score"] < corpus_pipeline.GOOD}
    assert rejected and {r["doc_id"] for r in scored} - {r["doc_id"] for r in spark.read.parquet(f"{path}/0").collect()} == rejected


def test_pipeline_of_nothing(spark, empty, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert docs.count() == 0
