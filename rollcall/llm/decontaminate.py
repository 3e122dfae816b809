"""Test items inside documents: size-partitioned MinHash search for containment, then exact shingle containment.

Test items are partitioned by the number of their distinct shingles: class ``hi`` holds items of more than ``hi / 2`` and at
most ``hi`` shingles. A document is searched in windows fit for each class: blocks of ``hi / 4`` shingles, and every run of
blocks long enough to cover ``hi`` shingles wherever they begin. So however long the document is, an item is compared
with windows hardly larger than itself, and its share in their union stays above a quarter. One minimum per hash function and
window is compared with those of the items of the class; one equal minimum makes the pair a candidate. With
``HASHES`` functions an item held to 3/4 in one place is missed with a chance below one in a hundred million, and what lies scattered
gets a try in each window. Candidates are verified on all shingles of the document:
``4 * shared >= 3 * shingles of the item``.

The search is one pass over the documents without a shuffle. Items are the query set: they are read to the driver in blocks
of ``ITEM_BYTES`` and one pass is made for each block.

Words and shingles are those of ``words``. An item of fewer than five words (one at least) is one shingle of that many words,
looked for at that width. Cases: null or empty items match nothing, and neither do null or empty documents. Repeated items
and repeated documents give a row each. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rollcall.llm import words
from rollcall.llm.common import slices, tidy, utf8

SHINGLE = 5
HASHES = 64
ITEM_BYTES = 16 << 20
_rng = np.random.default_rng(20)
_TIMES = (_rng.integers(0, 1 << 31, HASHES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_FLIP = _rng.integers(0, 1 << 32, HASHES).astype(np.uint32)


class _SizeClass:
    """Items of one shingle width and size class."""

    def __init__(self, hi: int, tokens: list[np.ndarray], numbers: list[int]):
        self.block = max(1, hi // 4)
        self.blocks = hi // self.block + 1
        self.numbers = np.array(numbers)
        low = [(t >> np.uint64(32)).astype(np.uint32) for t in tokens]
        self.filters, self.minima, self.orders = [], [], []
        for times, flip in zip(_TIMES, _FLIP, strict=True):
            least = np.array([((x ^ flip) * times).min() for x in low], np.uint32)
            order = np.argsort(least, kind="stable")
            marks = np.zeros(1 << 16, bool)
            marks[least & np.uint32(0xFFFF)] = True
            self.filters.append(marks)
            self.minima.append(least[order])
            self.orders.append(order)

    def hits(self, k: int, window: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item number) of equal minima under function ``k``."""
        some = np.flatnonzero(self.filters[k][window & np.uint32(0xFFFF)])
        if not len(some):
            return
        value, table = window[some], self.minima[k]
        lo, hi = np.searchsorted(table, value, "left"), np.searchsorted(table, value, "right")
        for w, a, b in zip(some[lo < hi], lo[lo < hi], hi[lo < hi], strict=True):
            for j in range(a, b):
                yield int(w), int(self.numbers[self.orders[k][j]])


class Search:
    """Index of a block of test items."""

    def __init__(self, texts: list[str | None]):
        hashes, first = words.words(*utf8(pa.array(texts, pa.large_string())))
        self.tokens: dict[int, np.ndarray] = {}
        by: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for width in range(1, SHINGLE + 1):
            found, at = words.shingles(hashes, first, width)
            for i, n in enumerate(np.diff(first)):
                if n == width or n > width == SHINGLE:
                    self.tokens[i] = np.unique(found[at[i] : at[i + 1]])
                    by[width][1 << (len(self.tokens[i]) - 1).bit_length()].append(i)
        self.widths = {
            w: [_SizeClass(hi, [self.tokens[i] for i in rows], rows) for hi, rows in sorted(sizes.items())]
            for w, sizes in by.items()
        }

    def _candidates(self, classes: list[_SizeClass], tokens: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a minimum in some window."""
        size = np.diff(at)
        layout = []
        below, from_ = 1, at  # blocks are made from those of the class before
        for c in classes:
            many = -(-size // c.block)
            text = np.repeat(np.arange(len(size)), many)
            begin = np.concatenate(([0], np.cumsum(many)))
            starts = from_[text] + (np.arange(len(text)) - begin[text]) * (c.block // below)
            below, from_ = c.block, begin
            room = [np.flatnonzero(text[:-d] != text[d:]) for d in range(1, c.blocks)]
            layout.append((c, text, starts, room))
        out: set[tuple[int, int]] = set()
        short = (tokens >> np.uint64(32)).astype(np.uint32)
        for k in range(HASHES):
            least = (short ^ _FLIP[k]) * _TIMES[k]
            for c, text, starts, room in layout:
                least = np.minimum.reduceat(least, starts) if c.block > 1 else least
                window = least.copy()
                for d, ends in enumerate(room, 1):
                    if d < len(least):
                        other = least[d:].copy()
                        other[ends] = np.uint32(0xFFFFFFFF)
                        np.minimum(window[:-d], other, out=window[:-d])
                out.update((int(text[w]), item) for w, item in c.hits(k, window))
        return out

    def find(self, column: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, shingles of the item, shared) of all matches, by row."""
        for lo, hi in slices(column):
            hashes, first = words.words(*utf8(column[lo:hi]))
            found = []
            for width, classes in self.widths.items():
                tokens, at = words.shingles(hashes, first, width)
                if not len(tokens):
                    continue
                by_text = defaultdict(list)
                for text, item in self._candidates(classes, tokens, at):
                    by_text[text].append(item)
                for text, items in by_text.items():
                    own = np.unique(tokens[at[text] : at[text + 1]])
                    for item in items:
                        shared = len(np.intersect1d(own, self.tokens[item], assume_unique=True))
                        if 4 * shared >= 3 * len(self.tokens[item]):
                            found.append((lo + text, item, len(self.tokens[item]), shared))
            yield from sorted(found)


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, list[str]]]:
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // ITEM_BYTES)
    for b in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        if own:
            yield [r["id"] for r in own], [r["text"] for r in own]


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs (``id_col``, ``item_id_col``, n_item, n_shared) of documents that hold an item to 3/4 at least."""
    spark = docs.sparkSession
    kind, item_kind = dict(docs.dtypes)[id_col], items.schema[item_id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {kind}, item {item_kind.simpleString()}, n_item int, n_shared int"
    item_arrow = to_arrow_type(item_kind)
    out = spark.createDataFrame([], schema)
    for ids, texts in _item_blocks(items, item_id_col, item_text_col):
        held = spark.sparkContext.broadcast((texts, ids))

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            texts, ids = held.value
            index = Search(texts)
            for b in batches:
                found = list(index.find(b.column("text")))
                row, item, n, shared = zip(*found, strict=True) if found else ((), (), (), ())
                yield pa.record_batch(
                    [
                        b.column("id").take(pa.array(row, pa.int64())),
                        pa.array([ids[i] for i in item], item_arrow),
                        pa.array(n, pa.int32()),
                        pa.array(shared, pa.int32()),
                    ],
                    ["id", "item", "n_item", "n_shared"],
                )

        out = out.union(rows.mapInArrow(tidy(search), schema))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_id_col), "n_item", "n_shared")


def _without(held: Broadcast, at: int):
    """Batches without the rows whose text, column ``at``, holds an item; no text becomes a Python string."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Search(held.value)
        for b in batches:
            stay = np.ones(b.num_rows, bool)
            stay[[m[0] for m in index.find(b.column(at))]] = False
            yield b if stay.all() else b.filter(pa.array(stay))

    return tidy(keep)


def without_items(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``docs`` without the rows that hold a test item."""
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    out = docs
    for _, texts in _item_blocks(items, item_id_col, item_text_col):
        out = out.mapInArrow(_without(docs.sparkSession.sparkContext.broadcast(texts), at), docs.schema)
    return out
