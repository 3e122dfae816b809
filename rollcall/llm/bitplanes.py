"""Token ids in shuffled planes: fixed-size blocks, transposed to byte or bit planes, each compressed by zstandard.

A block holds ``BLOCK`` ids of a part (the last one fewer): 32-bit ids are laid out plane by plane (all first bytes, all second
bytes ..., or all first bits ...), so that alike values lie side by side; a plane of zeros takes no bytes. Layout of a block::

    "BPL1", u8 kind (0 byte, 1 bit planes), u8 planes, u16 zero, u32 ids, u32 crc32 of the ids as little-endian u32,
    u32 length of each plane, the planes

Documents are put in ascending order (id, then a hash of the text; null ids first) by one range shuffle; each task writes one
part. Files are Parquet, uncompressed, one row per block with its chunk index: ``part``, ``block``, ``first`` (ids before it in
the part), ``n_ids``, ``payload``, and of the documents that begin in it ``doc_ids``, ``doc_first`` (place in the part) and
``doc_len``. Spark's writer commits them, so lost executors leave no half files, and any store that Spark reaches will do.

Encoding splits a text at ASCII white space and before punctuation that ends a word, which no token of a lower-casing
word tokenizer crosses, and asks the library once for each distinct piece it does not remember; ``split=False`` encodes whole
texts and holds for any tokenizer.

Cases: a null or empty text is the end id alone. Repeated rows are documents of their own. An empty table writes no blocks and
reads back as no rows. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from rollcall.llm.common import shuffle_parts, slices, utf8
from rollcall.llm.remembered import Remembered, cut_at

BLOCK = 1 << 14
END = 1
BYTE, BIT = 0, 1
#: Half of the distinct pieces whose ids a worker remembers.
REMEMBERED = 300_000
_HEAD = struct.Struct("<4sBBHII")
#: A piece that ends in punctuation after a Latin letter or digit: where the tokenizer divides as well.
_TAIL = re.compile(r"([\x00-;=-\xff]*[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([.,;:!?|]*)", re.S)
#: Lower-case letters that no normalisation changes.
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN = re.compile(f"[{_LETTERS}]+")
_GAPS = " \t\n\r\x0b\x0c"
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[ord(c) for c in _GAPS]] = True
#: Bytes of text that are encoded at once.
SLICE = 8 << 20


class _Memory:
    """Bounded map that keeps what was asked for lately."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        out = []
        for k in keys - self.new.keys():
            if (v := self.old.get(k)) is None:
                out.append(k)
            else:
                self.new[k] = v
        return out

    def turn(self) -> None:
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}


class Encoder:
    """Ids of texts as little-endian u32 bytes."""

    def __init__(self, path: str, split: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.split = split
        self.pieces, self.stems = Remembered(2 * REMEMBERED), _Memory(REMEMBERED)
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in _LETTERS}
        self.model = self.tokenizer.model
        self.direct = split and self._is_direct()

    def _is_direct(self) -> bool:
        """Whether words of lower-case letters go to the model as they are, tried on words of all letters."""
        draw = np.random.default_rng(5)
        tried = ["".join(draw.choice(list(_LETTERS), n)) for n in range(1, 13) for _ in range(40)] + list(_LETTERS)
        return self._spelled(tried) == self._whole(tried)

    def _spelled(self, words: list[str]) -> list[bytes]:
        ask, letters = self.model.tokenize, self.letters
        found = (ask(w if w.isascii() else w.translate(letters)) for w in words)
        return [np.fromiter([x.id for x in t], "<u4", len(t)).tobytes() for t in found]

    def _whole(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _ask(self, pieces: list[str]) -> list[bytes]:
        if not self.direct:
            return self._whole(pieces)
        plain = [bool(_PLAIN.fullmatch(p)) for p in pieces]
        spelled = iter(self._spelled([p for p, yes in zip(pieces, plain, strict=True) if yes]))
        whole = iter(self._whole([p for p, yes in zip(pieces, plain, strict=True) if not yes]))
        return [next(spelled if yes else whole) for yes in plain]

    def _learn(self, new: list[bytes]) -> list[bytes]:
        parts = []
        for k in (p.decode() for p in new):
            m = _TAIL.fullmatch(k)  # Latin-1 throughout, where lower() is what the tokenizer does; no "<" of a special token
            parts.append((m[1].lower(), m[2]) if m else (k, ""))
        stems = self.stems
        asked = stems.missing({x for pair in parts for x in pair})
        stems.new.update(zip(asked, self._ask(asked), strict=True))
        found = [stems.new[x] + stems.new[y] for x, y in parts]
        stems.turn()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        ids, at = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (one place more at the end).

        Pieces are cut on the buffer, from which the gaps are taken out; ids of distinct ones are gathered.
        """
        if not self.split:
            found = self._ask(texts.to_pylist())
            size = np.array([len(x) // 4 for x in found], np.int64)
            return np.frombuffer(b"".join(found), "<u4"), np.concatenate(([0], np.cumsum(size)))
        data, at = utf8(texts)
        ink = ~_IS_GAP[data]
        starts = ink.copy()
        starts[1:] &= ~ink[:-1]
        begin = at[:-1][at[:-1] < len(data)]
        starts[begin] = ink[begin]
        pieces = cut_at(data[ink], np.flatnonzero(starts[ink]))
        ids = self.pieces.ids_of(pieces, self._learn)
        return ids.flatten().to_numpy(), ids.offsets.to_numpy()[np.searchsorted(np.flatnonzero(starts), at, "left")]


@lru_cache(maxsize=2)
def _encoder(path: str, split: bool) -> Encoder:
    """A worker's encoder: what one task learnt serves the next."""
    return Encoder(path, split)


def pack(ids: np.ndarray, kind: int = BYTE) -> bytes:
    """A block of ids."""
    raw = ids.astype("<u4").tobytes()
    planes = np.frombuffer(raw, np.uint8).reshape(-1, 4).T
    if kind == BIT:
        bits = np.unpackbits(np.ascontiguousarray(planes), axis=0, bitorder="little")  # 8 rows for each byte plane
        planes = np.packbits(bits, axis=1)
    press = zstandard.ZstdCompressor(level=3)
    bodies = [press.compress(np.ascontiguousarray(p).tobytes()) if p.any() else b"" for p in planes]
    head = _HEAD.pack(b"BPL1", kind, len(bodies), 0, len(ids), zlib.crc32(raw))
    return head + struct.pack(f"<{len(bodies)}I", *map(len, bodies)) + b"".join(bodies)


def unpack(payload: bytes) -> np.ndarray:
    magic, kind, count, _, n, crc = _HEAD.unpack_from(payload)
    if magic != b"BPL1":
        raise ValueError("not a block of ids")
    sizes = struct.unpack_from(f"<{count}I", payload, _HEAD.size)
    at = _HEAD.size + 4 * count
    width = n if kind == BYTE else -(-n // 8)
    planes = np.zeros((count, width), np.uint8)
    press = zstandard.ZstdDecompressor()
    for plane, size in zip(planes, sizes, strict=True):
        if size:
            plane[:] = np.frombuffer(press.decompress(payload[at : at + size]), np.uint8)
        at += size
    if kind == BIT:
        planes = np.packbits(np.unpackbits(planes, axis=1, count=n), axis=0, bitorder="little")
    raw = np.ascontiguousarray(planes.T).tobytes()
    if zlib.crc32(raw) != crc:
        raise ValueError("a block of ids is damaged")
    return np.frombuffer(raw, "<u4")


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int | None = None,
    block: int = BLOCK,
    kind: int = BYTE,
    split: bool = True,
) -> None:
    """Encodes ``docs`` into files under ``path``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    parts = parts or shuffle_parts(docs.sparkSession)
    id_kind = dict(rows.dtypes)["id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer, split), TaskContext.get().partitionId()
        buffer, done, number = bytearray(), 0, 0
        begun: list[tuple[object, int, int]] = []  # documents not yet in a block: id, first, length
        ids_type = None

        def flush(n: int) -> pa.RecordBatch:
            nonlocal done, number, begun
            ids = np.frombuffer(bytes(buffer[: 4 * n]), "<u4")
            del buffer[: 4 * n]
            m = bisect_left(begun, done + n, key=lambda d: d[1])
            own, begun = begun[:m], begun[m:]
            row = pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([number], pa.int32()),
                    "first": pa.array([done], pa.int64()),
                    "n_ids": pa.array([n], pa.int32()),
                    "payload": pa.array([pack(ids, kind)], pa.binary()),
                    "doc_ids": pa.array([[d[0] for d in own]], pa.list_(ids_type)),
                    "doc_first": pa.array([[d[1] for d in own]], pa.list_(pa.int64())),
                    "doc_len": pa.array([[d[2] for d in own]], pa.list_(pa.int64())),
                }
            )
            done, number = done + n, number + 1
            return row

        for b in batches:
            names, texts = b.column("id").to_pylist(), b.column("text")
            ids_type = b.column("id").type
            for lo, hi in slices(texts, SLICE):
                ids, at = encoder.encode_column(texts[lo:hi])
                size = np.diff(at) + 1
                ended = np.full(len(ids) + len(size), END, "<u4")
                ended[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size - 1)] = ids
                first = done + len(buffer) // 4 + np.cumsum(size) - size
                begun += zip(names[lo:hi], first.tolist(), size.tolist(), strict=True)
                buffer += ended.tobytes()
                while len(buffer) >= 4 * block:
                    yield flush(block)
        if buffer:
            yield flush(len(buffer) // 4)

    schema = (
        "part int, block int, first long, n_ids int, payload binary, "
        f"doc_ids array<{id_kind}>, doc_first array<long>, doc_len array<long>"
    )
    (
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(encode, schema)
        .write.option("compression", "none")
        .mode("errorifexists")
        .parquet(path)
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(id, part, first, length, arrays of ids) of each document, from blocks in order; long ones in many arrays."""
    at: tuple[int, int] | None = None
    waiting: list[tuple] = []
    now: list[np.ndarray] = []
    have = 0
    for b in batches:
        for r in b.to_pylist():
            if at is not None and at != (r["part"], r["block"] - 1) and (at[0] == r["part"] or r["block"]):
                raise ValueError(f"a block is missing before {r['part']}:{r['block']}")
            at = r["part"], r["block"]
            ids = unpack(r["payload"])
            waiting += zip(r["doc_ids"], [r["part"]] * len(r["doc_ids"]), r["doc_first"], r["doc_len"], strict=True)
            used = 0
            while waiting and used < len(ids):
                take = min(waiting[0][3] - have, len(ids) - used)
                now.append(ids[used : used + take])
                used, have = used + take, have + take
                if have == waiting[0][3]:
                    yield (*waiting.pop(0), now)
                    now, have = [], 0
    if waiting:
        raise ValueError("the last block of a part is missing")


def _blocks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, str]:
    """Blocks in order, ids before each part, and the type of the document ids."""
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ordered = files.repartition(shuffle_parts(spark), "part").sortWithinPartitions("part", "block")
    return ordered, F.broadcast(starts), files.schema["doc_ids"].dataType.elementType.simpleString()


def _noting(batches: Iterator[pa.RecordBatch], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """The batches; ``kinds`` gets the type of the document ids."""
    for b in batches:
        kinds[:] = [b.column("doc_ids").type.value_type]
        yield b


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``ids``."""
    ordered, starts, kind = _blocks(spark, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []
        for name, part, first, _, ids in _documents(_noting(batches, kinds)):
            row = {
                "doc_id": pa.array([name], kinds[0]),
                "part": pa.array([part], pa.int32()),
                "first": pa.array([first], pa.int64()),
                "ids": pa.array([np.concatenate(ids).astype(np.int64)], pa.list_(pa.int64())),
            }
            yield pa.record_batch(row)

    found = ordered.mapInArrow(decode, f"doc_id {kind}, part int, first long, ids array<long>")
    return found.join(starts, "part").select("doc_id", (F.col("_before") + F.col("first")).alias("start"), "ids")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""
    ordered, starts, kind = _blocks(spark, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            types = (kinds[0], pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "part", "first", "n_tokens", "ids_crc32")
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for name, part, first, n, ids in _documents(_noting(batches, kinds)):
            crc = 0
            for piece in ids:
                crc = zlib.crc32(piece.tobytes(), crc)
            rows.append((name, part, first, n, crc))
            if len(rows) == 10_000:
                yield out()
                rows.clear()
        if rows:
            yield out()

    found = ordered.mapInArrow(decode, f"doc_id {kind}, part int, first long, n_tokens long, ids_crc32 long")
    return found.join(starts, "part").select(
        "doc_id", (F.col("_before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
