"""Licence statements in documents by conditional compression against templates, confirmed on their wording.

A cue word opens a candidate block that reaches as many words before and after it as a confirmed notice may have, over line
ends; blocks that overlap are one. A block is compressed by zstandard alone and with each template as raw dictionary. For each
template that saves bytes, the wording is compared: the words of template and block, without punctuation, are aligned in every stretch that holds enough
words of the template, and a template is confirmed when at least ``WORDS`` of its words stand there in order and no number or
negation differs inside the aligned stretch. Of confirmed stretches that overlap, the one with most words in common, less those
missing and put in between, gives the row, so all statements of a block are found. The row says which words of the
template are missing and which were put in between.

Templates are given as (licence, text). ``TEMPLATES`` holds notices in common use. Scanning is one pass without a shuffle; texts
without a cue never leave the JVM.

Cases: null and empty texts give no row. Repeated documents and repeated statements give a row each. Of equal stretches the template
that saves more counts, then the longer one, then the first in order. Of an SPDX expression the first identifier is reported. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words, one of which any notice holds; the same pattern for Java and Python.
CUE = r"(?i)licen[cs]e|copyright|©|all\W+rights\W+reserved|creative\W+commons|\bCC\W*(?:BY|0)|spdx|permission\W+is\W+hereby\W+granted|redistribution\W+and\W+use|public\W+domain|unlicense"
#: Share of a template's words that must stand in a block.
WORDS = 0.85
LEVEL = 3
_WORD = re.compile(r"[\w.]*\w")
#: What shows that an identifier goes on.
_MORE = re.compile(r"-\w")
#: Identifiers of SPDX tags, by the licence they stand for.
SPDX = {
    "MIT": ("MIT",),
    "MIT-0": ("MIT-0",),
    "ISC": ("ISC",),
    "Apache-2.0": ("Apache-2.0",),
    "BSD": ("BSD-2-Clause", "BSD-3-Clause", "0BSD"),
    "MPL-2.0": ("MPL-2.0",),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0-1.0",),
    **{f"CC-{x}-4.0": (f"CC-{x}-4.0",) for x in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
    **{x: (x, f"{x}-only", f"{x}-or-later") for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")},
}
TAG = "SPDX-License-Identifier: "

#: Fixed wordings of common notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0"),
    ("proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((name, TAG + x) for name, ids in SPDX.items() for x in ids),
)


def _words(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def _room(n: int) -> int:
    """Words that may be put into a template of ``n`` words."""
    return int(n * (1 - WORDS) + 3)


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.templates = templates
        self.words = [[w for w, _, _ in _words(t)] for _, t in templates]
        self.tails = [t[max((m.end() for m in _WORD.finditer(t)), default=len(t)) :] for _, t in templates]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = []
        for _, text in templates:
            held = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.given.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False))
        self.sets = [frozenset(w) for w in self.words]
        self.reach = max((len(w) + _room(len(w)) for w in self.words), default=0)
        self.cue = re.compile(CUE)

    def blocks(self, text: str) -> Iterator[list[tuple[str, int, int]]]:
        """Words of each candidate block."""
        words = _words(text)
        begins = [x for _, x, _ in words]
        lo = hi = 0
        for m in self.cue.finditer(text):
            first = max(0, bisect_right(begins, m.start()) - 1 - self.reach)
            if hi and first > hi:
                yield words[lo:hi]
                lo, hi = first, 0
            elif not hi:
                lo = first
            hi = min(len(words), bisect_right(begins, m.end()) + self.reach)
        if hi:
            yield words[lo:hi]

    def saved(self, block: str, template: int) -> int:
        """Bytes that the template as a dictionary saves on a candidate block."""
        raw = block.encode()
        return len(self.plain.compress(raw)) - len(self.given[template].compress(raw))

    def wording(self, have: list[str], template: int) -> tuple[int, int, list[str], list[str]] | None:
        """First and last aligned word, missing words, added words of the best confirmed part; None if there is none."""
        want, best = self.words[template], None
        spans = [m for m in SequenceMatcher(None, have, want, autojunk=False).get_matching_blocks() if m.size]
        for i in range(len(spans)):
            for j in range(len(spans), i, -1):
                part = spans[i:j]
                held = sum(m.size for m in part)
                if held < WORDS * len(want):
                    break
                first, last = part[0].a, part[-1].a + part[-1].size
                if last - first - held > _room(len(want)):
                    continue
                here, there = set(), set()
                for m in part:
                    here.update(range(m.a, m.a + m.size))
                    there.update(range(m.b, m.b + m.size))
                added = [have[k] for k in range(first, last) if k not in here]
                missing = [w for k, w in enumerate(want) if k not in there]
                if any(w == "not" or w[0].isdigit() for w in added + missing):
                    continue
                if best is None or len(missing) + len(added) < len(best[2]) + len(best[3]):
                    best = first, last, missing, added
        return best

    def pieces(self, have: list[str], template: int) -> Iterator[tuple[int, int]]:
        """Parts of a block where enough of the template's words stand close together, each of twice their room at most.

        A block of any length is cut into such candidates, so a short notice in a long block is compressed beside its own surroundings.
        """
        want, known = self.words[template], self.sets[template]
        size = len(want) + _room(len(want))
        held = [0, *accumulate(w in known for w in have)]
        lo = hi = -1
        for k, w in enumerate(have):
            end = min(len(have), k + size)
            if w in known and held[end] - held[k] >= WORDS * len(want) and len(known.difference(have[k:end])) <= (1 - WORDS) * len(want):
                if lo >= 0 and end - lo <= 2 * size:
                    hi = end
                    continue
                if lo >= 0:
                    yield lo, hi
                lo, hi = k, end
        if lo >= 0:
            yield lo, hi

    def stretches(self, have: list[str], template: int) -> Iterator[tuple[int, int, list[str], list[str]]]:
        """Confirmed parts of a candidate for one template."""
        want, known = self.words[template], self.sets[template]
        size = len(want) + _room(len(want))
        for k, w in enumerate(have):
            if w in known and (found := self.wording(have[k : k + size], template)) is not None:
                yield k + found[0], k + found[1], found[2], found[3]

    def scan(self, text: str) -> list[tuple[int, int, str, int, int, list[str], list[str]]]:
        """(begin, end, licence, template, bytes saved, missing, added) of all statements, in order."""
        out = []
        for words in self.blocks(text):
            have = [w for w, _, _ in words]
            if not words:
                continue
            found = []
            for lo, hi, k in ((lo, hi, k) for k in range(len(self.templates)) for lo, hi in self.pieces(have, k)):
                saved = self.saved(text[words[lo][1] : words[hi - 1][2]], k)
                for first, last, missing, added in self.stretches(have[lo:hi], k):
                    first, last = first + lo, last + lo
                    end = words[last - 1][2]
                    if self.templates[k][1].startswith(TAG) and _MORE.match(text, end):
                        continue
                    common = len(self.words[k]) - len(missing)
                    rank = (-saved, -len(self.words[k]), k)
                    found.append((len(missing) + len(added) - common, rank, first, last, k, saved, missing, added))
            taken = bytearray(len(words))
            for _, _, first, last, k, saved, missing, added in sorted(found):
                if any(taken[first:last]):
                    continue
                taken[first:last] = b"\1" * (last - first)
                end = words[last - 1][2]
                if text.startswith(self.tails[k], end):
                    end += len(self.tails[k])
                out.append((words[first][1], end, self.templates[k][0], k, saved, missing, added))
        return sorted(out)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """One row per statement: ``id_col``, ``license``, ``start`` and ``length`` in code points, ``template``, ``saved``,
    ``missing``, ``added``."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike(CUE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for b in batches:
            at, found = [], []
            for i, text in enumerate(b.column("text")):
                more = scanner.scan(text.as_py())
                found += more
                at += [i] * len(more)
            cols = list(zip(*found, strict=True)) if found else [()] * 7
            yield pa.record_batch(
                {
                    "id": b.column("id").take(pa.array(at, pa.int64())),
                    "license": pa.array(cols[2], pa.string()),
                    "start": pa.array(cols[0], pa.int64()),
                    "length": pa.array([y - x for x, y in zip(cols[0], cols[1], strict=True)], pa.int64()),
                    "template": pa.array(cols[3], pa.int32()),
                    "saved": pa.array(cols[4], pa.int32()),
                    "missing": pa.array(cols[5], pa.list_(pa.string())),
                    "added": pa.array(cols[6], pa.list_(pa.string())),
                }
            )

    schema = f"id {kind}, license string, start long, length long, template int, saved int, missing array<string>, added array<string>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
