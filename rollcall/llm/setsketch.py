r"""Near copies by SetSketch registers: banded, judged by joint likelihood, confirmed on whole shingle sets.

1. *Registers.* A set's register i is ``floor(1 - log_b(h))``, cut to 0..255, where h is the least exponential value that a hash
   gives to its elements: truncated minima on an exponential scale. The register of a union is the larger one of both, so sketches
   merge; two sets agree in a register about as often as they are alike. Equal sets are one class with one sketch.
2. *Bands.* ``ROWS`` registers are one key, packed without loss. Two classes at the threshold share none of ``BANDS`` keys with a
   chance of 3e-7. A key that one class has alone is dropped.
3. *Linking before comparing.* In a few rounds every class is tested with ``LEADERS`` classes of other components, the leaders of its
   buckets in random orders, so that a group of near copies is joined by a linear number of tests. Buckets of one component are finished.
4. *The rest, exactly.* The members of other buckets are sorted by key and component and packed into blocks of ``BLOCK`` sketches. All pairs
   of two components in blocks of one key are compared on registers inside a task; pairs of blocks that hold one component alone, or whose sizes
   are too far apart, are never met. A pair is compared in the first band that it shares, and nowhere else.
5. *Likelihood.* A pair's larger, smaller and equal registers and the known set sizes give the joint likelihood of each similarity. Pairs for
   which the threshold is less likely than the best similarity by more than ``exp(-DOUBT)`` are dropped, a chance below 1e-7 at the threshold.
6. *Confirmed.* Those left link if 100 * intersection >= 85 * union of the whole sets (``set_pairs``). The set of a leader is sent once
   for each ``FAN`` of its pairs and they stream past it; the pairs of two blocks stay one row, to which the sets of its members come, so
   what moves grows with the members of a group, not with their pairs.

Cases: null and empty texts have no shingles, link with nothing and are their own component. Repeated rows are one class. Rows with a null
id take part; a component of which no row has an id has a null ``component_id``, and a row without an id is not kept. An empty table
gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm import words
from rollcall.llm.common import cut, shuffle_parts, slices, utf8
from rollcall.llm.components import stars
from rollcall.llm.jaccard_join import class_key, sets_of, token_sets
from rollcall.llm.set_pairs import confirmed, joined_lists
from rollcall.operators.lookup import attach

BASE, RATE = 1.1, 10.0
ROWS, BANDS = 6, 30
REGISTERS = ROWS * BANDS
#: Least similarity in percent.
ALIKE = 85
DOUBT = 16.0
LIKELY = 2.0
#: Rounds of linking before comparing, at most, and leaders that a member is tested with in one; a round is the last one if it leaves
#: more than ``STALE`` of the members.
ROUNDS = 5
LEADERS = 4
STALE = 0.9
BLOCK = 256
#: Pairs whose likelihood is worked out at once.
JUDGED = 1 << 15
#: Shingles that are hashed at once.
_IN_STEP = 1 << 17

_FLIP = words.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_ODD = words.mix(_FLIP) | np.uint64(1)


def registers(tokens: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sketches (sets x ``REGISTERS``) of sets of distinct 64-bit elements, none empty, that begin at ``begin``."""
    least = np.empty((len(begin), REGISTERS), np.uint64)
    buffer = np.empty_like(tokens)
    for i in range(REGISTERS):
        np.bitwise_xor(tokens, _FLIP[i], out=buffer)
        np.multiply(buffer, _ODD[i], out=buffer)
        least[:, i] = np.minimum.reduceat(buffer, begin)
    h = -np.log1p(-(least.astype(float) + 0.5) / 2.0**64 * (1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(h) / math.log(BASE)), 0, 255).astype(np.uint8)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union."""
    return np.maximum(a, b)


def _tilt(x: np.ndarray) -> np.ndarray:
    """Chance that one register is larger, where a share ``x`` of the union is in its set alone."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def doubt(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, steps: int = 32) -> np.ndarray:
    """Log-likelihood that pairs lose if their similarity is at least ``ALIKE``, from counts of larger and smaller registers."""
    u = n_a / (n_a + n_b)
    top = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    bound = ALIKE / 100
    same = REGISTERS - more - less

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = _tilt(u - (1 - u) * j), _tilt(1 - u - u * j)
        tiny = 1e-12
        return more * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(q, tiny)) + same * np.log(np.maximum(1 - p - q, tiny))

    best = np.full(len(u), -np.inf)
    for k in range(steps + 1):
        best = np.maximum(best, likelihood(np.minimum(bound, top) * k / steps))
    high = np.full(len(u), -np.inf)
    for k in range(9):
        high = np.maximum(high, likelihood(bound + np.maximum(top - bound, 0) * k / 8))
    return np.where(top < bound, np.inf, np.maximum(best - high, 0))


def sketches(docs: DataFrame) -> DataFrame:
    """Stored (id, n, k1, k2, sketch) of every row; the sketch of an empty set is null."""
    kind = dict(docs.dtypes)["id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text")
            for lo, hi in slices(text):
                sets = list(token_sets(text[lo:hi]))
                size = np.array([len(s) for s in sets], np.int64)
                found: list[bytes | None] = [None] * len(sets)
                some = np.flatnonzero(size)
                ends = np.cumsum(size[some])
                at = 0
                while at < len(some):
                    base = ends[at - 1] if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, base + _IN_STEP, "right")))
                    begin = np.concatenate(([0], ends[at : to - 1] - base)).astype(np.int64)
                    for i, row in zip(some[at:to], registers(np.concatenate([sets[i] for i in some[at:to]]), begin), strict=True):
                        found[i] = row.tobytes()
                    at = to
                keys = [class_key(s) for s in sets]
                yield pa.record_batch(
                    {
                        "id": b.column("id")[lo:hi],
                        "n": pa.array(size.astype(np.int32)),
                        "k1": pa.array([k[0] for k in keys], pa.int64()),
                        "k2": pa.array([k[1] for k in keys], pa.int64()),
                        "sketch": pa.array(found, pa.binary()),
                    }
                )

    return cut(docs.mapInArrow(read, f"id {kind}, n int, k1 long, k2 long, sketch binary"))


def classes(rows: DataFrame) -> DataFrame:
    """Stored (cid, k1, k2, n, id, sketch): distinct sets with their smallest id."""
    some = rows.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch"))
    return cut(some.withColumn("cid", F.monotonically_increasing_id()))


def bands(found: DataFrame) -> DataFrame:
    """(key, cid): the keys of each class; the band stands above the registers' 48 bits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(BANDS, dtype=np.int64) << 48
        for b in batches:
            sketch = np.frombuffer(utf8(b.column("sketch"))[0].tobytes(), np.uint8).reshape(-1, BANDS, ROWS).astype(np.int64)
            key = (sketch << (8 * np.arange(ROWS, dtype=np.int64))).sum(2) + place
            yield pa.record_batch({"key": pa.array(key.ravel()), "cid": pa.array(np.repeat(b.column("cid").to_numpy(), BANDS))})

    return found.select("cid", "sketch").mapInArrow(read, "key long, cid long")


def likely(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that are likely to link by their sketches. What this leaves out is compared later."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(utf8(b.column(c))[0].tobytes(), np.uint8).reshape(-1, REGISTERS) for c in ("x", "y"))
            n_a, n_b = (b.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            keep = pa.array(doubt((x > y).sum(1), (x < y).sum(1), n_a, n_b) <= LIKELY)
            yield pa.record_batch({"a": b.column("a").filter(keep), "b": b.column("b").filter(keep)})

    for end, sketch in (("a", "x"), ("b", "y")):
        facts = found.select(F.col("cid").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(sketch))
        pairs = attach(pairs, facts.hint("merge"), [end], "inner")  # sketches of all classes don't pass the driver
    return pairs.filter(f"100L * least(n_a, n_b) >= {ALIKE}L * greatest(n_a, n_b)").mapInArrow(read, "a long, b long")


def _labelled(members: DataFrame, star: DataFrame | None) -> DataFrame:
    """Members (key, cid) of the buckets that still hold two labels, with their label. Stored."""
    if star is not None:
        named = attach(members.select("key", "cid"), star.select(F.col("u").alias("cid"), F.col("v").alias("root")), ["cid"])
        members = named.select("key", "cid", F.coalesce("root", "cid").alias("label"))
    else:
        members = members.select("key", "cid", F.col("cid").alias("label"))
    mixed = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return cut(attach(members, mixed.select("key"), ["key"], "inner"))


def leader_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Up to ``LEADERS`` pairs (a, b) for each member, with leaders of its buckets of other labels, each in a random order of its own."""
    ways = range(LEADERS)
    order = [F.struct(F.xxhash64("label", F.lit(turn * LEADERS + k)).alias("h"), "label", "cid") for k in ways]
    leaders = members.groupBy("key").agg(*[F.min(o).alias(f"lead{k}") for k, o in enumerate(order)])
    met = attach(members, leaders, ["key"], "inner")
    other = lambda k: F.min(F.when(F.col("label") != F.col(f"lead{k}.label"), F.col(f"lead{k}")))
    own = met.groupBy("cid").agg(*[other(k).alias(f"lead{k}") for k in ways])
    pairs = own.select("cid", F.explode(F.array_distinct(F.array(*[F.col(f"lead{k}.cid") for k in ways]))).alias("a"))
    return pairs.filter("a IS NOT NULL").select("a", F.col("cid").alias("b"))


def packed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Stored blocks of at most ``BLOCK`` members of one bucket, in the order of their labels."""
    full = attach(members, found.select("cid", "n", "sketch").hint("merge"), ["cid"], "inner")
    laid = full.repartitionByRange(shuffle_parts(members.sparkSession), "key", "label", "cid").sortWithinPartitions("key", "label", "cid")
    names = ["cids", "labels", "sizes", "sketches"]
    schema = "key long, place long, low long, high long, n0 int, n1 int, cids binary, labels binary, sizes binary, sketches binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, left = 0, None
        for b in batches:
            now = (
                b.column("key").to_numpy(),
                b.column("cid").to_numpy(),
                b.column("label").to_numpy(),
                b.column("n").to_numpy(),
                np.frombuffer(utf8(b.column("sketch"))[0].tobytes(), np.uint8).reshape(-1, REGISTERS),
            )
            if left is not None:
                now = tuple(np.concatenate(x) for x in zip(left, now, strict=True))
            key = now[0]
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            left = tuple(x[begin[-1] :] for x in now)  # the last bucket may go on
            if len(left[0]) >= 4 * BLOCK:
                begin, left = np.append(begin, len(key)), None
            spans = [(s, min(s + BLOCK, e)) for lo, e in zip(begin[:-1], begin[1:], strict=True) for s in range(lo, e, BLOCK)]
            if spans:
                yield rows(now, spans, place)
                place += len(spans)
        if left is not None and len(left[0]):
            yield rows(left, [(s, min(s + BLOCK, len(left[0]))) for s in range(0, len(left[0]), BLOCK)], place)

    def rows(now: tuple[np.ndarray, ...], spans: list[tuple[int, int]], place: int) -> pa.RecordBatch:
        key, cid, label, n, sketch = now
        return pa.record_batch(
            {
                "key": pa.array([key[s] for s, _ in spans], pa.int64()),
                "place": pa.array(range(place, place + len(spans)), pa.int64()),
                "low": pa.array([label[s] for s, _ in spans], pa.int64()),
                "high": pa.array([label[e - 1] for _, e in spans], pa.int64()),
                "n0": pa.array([n[s:e].min() for s, e in spans], pa.int32()),
                "n1": pa.array([n[s:e].max() for s, e in spans], pa.int32()),
                **{c: pa.array([x[s:e].tobytes() for s, e in spans], pa.binary()) for c, x in zip(names, (cid, label, n, sketch), strict=True)},
            }
        )

    done = laid.select("key", "cid", "label", "n", "sketch").mapInArrow(read, schema)
    return cut(done.withColumn("place", F.struct(F.spark_partition_id().alias("part"), "place")))


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Per pair of blocks the pairs of members (``a``, ``b``: lists of cids) of two labels that may link by their sketches, each pair once."""
    names, kinds = ["cids", "labels", "sizes", "sketches"], (np.int64, np.int64, np.int32, np.uint8)

    def read(b: pa.RecordBatch, r: int, end: str) -> list[np.ndarray]:
        return [np.frombuffer(b.column(f"{c}_{end}")[r].as_buffer(), t) for c, t in zip(names, kinds, strict=True)]

    def met_first(key: int, own: bool, one: list[np.ndarray], two: list[np.ndarray]) -> tuple[np.ndarray, ...] | None:
        """Ends, sizes and register counts of the pairs of two blocks whose first common band is this one."""
        fits = one[1][:, None] != two[1][None, :]
        n, m = one[2].astype(np.int64)[:, None], two[2].astype(np.int64)[None, :]
        fits &= 100 * np.minimum(n, m) >= ALIKE * np.maximum(n, m)
        i, j = np.nonzero(np.triu(fits, 1) if own else fits)
        if not len(i):
            return None
        x, y = one[3].reshape(-1, REGISTERS)[i], two[3].reshape(-1, REGISTERS)[j]
        first = (x == y).reshape(-1, BANDS, ROWS).all(2).argmax(1) == key >> 48
        i, j, x, y = i[first], j[first], x[first], y[first]
        return one[0][i], two[0][j], one[2][i], two[2][j], (x > y).sum(1), (x < y).sum(1)

    def judged(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        """One row for each pair of blocks with candidates."""
        a, b, n_a, n_b, more, less = (np.concatenate(c) for c in zip(*held, strict=True))
        keep = doubt(more, less, n_a.astype(float), n_b.astype(float)) <= DOUBT
        block = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])[keep]
        at = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)])) if len(block) else np.array([0])
        lists = lambda x: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x[keep]))
        return pa.record_batch({"a": lists(a), "b": lists(b)})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        many = 0
        for b in batches:
            for r in range(b.num_rows):
                found = met_first(b.column("key")[r].as_py(), b.column("own")[r].as_py(), read(b, r, "a"), read(b, r, "b"))
                if found is not None:
                    held.append(found)
                    many += len(found[0])
                if many >= JUDGED:
                    yield judged(held)
                    held, many = [], 0
        if held:
            yield judged(held)

    ends = lambda side: [F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in names]
    a, b = blocks.alias("a"), blocks.alias("b")
    itself = [F.col(c).alias(f"{c}_{e}") for e in "ab" for c in names]
    own = blocks.filter("low < high").select("key", F.lit(True).alias("own"), *itself)
    heads = blocks.select("key", "place", "low", "high", "n0", "n1")
    p, q = heads.alias("p"), heads.alias("q")
    open_ = F.expr(
        "p.key = q.key AND p.place < q.place AND least(p.low, q.low) < greatest(p.high, q.high)"
        f" AND 100L * q.n1 >= {ALIKE}L * p.n0 AND 100L * p.n1 >= {ALIKE}L * q.n0"
    )
    met = cut(p.join(q, open_).select("p.key", F.col("p.place").alias("one"), F.col("q.place").alias("two")))
    first = met.join(a.select("a.place", *ends("a")).withColumnRenamed("place", "one"), "one")
    cross = first.join(b.select("b.place", *ends("b")).withColumnRenamed("place", "two"), "two")
    cross = cross.select("key", F.lit(False).alias("own"), *[f"{c}_{e}" for e in "ab" for c in names])
    return own.unionByName(cross).mapInArrow(compare, "a array<long>, b array<long>")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id`` and ``kept``, whether its id is that of the component."""
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = sketches(docs)
    found = classes(rows)
    every = bands(found)
    several = every.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = _labelled(attach(every, several, ["key"], "inner"), None)
    wanted = members.select("cid").distinct()
    sets = sets_of(docs, cut(found.select("cid", "k1", "k2").join(wanted, "cid", "left_semi")))

    star, left = None, members.count()
    for turn in range(ROUNDS):
        edges = confirmed(likely(leader_pairs(members, turn), found), sets, ALIKE)
        star = stars(edges if star is None else edges.union(star))
        members = _labelled(members, star)
        before, left = left, members.count()
        if left > STALE * before or not left:
            break
    star = stars(joined_lists(block_pairs(packed(members, found)), sets, ALIKE).union(star))

    own = found.select("cid", "k1", "k2", "id").join(star.select(F.col("u").alias("cid"), "v"), "cid", "left")
    own = own.withColumn("label", F.coalesce("v", "cid"))
    least = own.groupBy("label").agg(F.min("id").alias("component_id"))
    answer = attach(own, least, ["label"]).select("k1", "k2", "component_id")
    n = F.col("n").cast("long").alias("n_shingles")
    full = attach(rows.filter("n > 0").select("id", "n", "k1", "k2"), answer, ["k1", "k2"], "inner")
    done = full.select("id", n, "component_id").union(rows.filter("n = 0").select("id", n, F.col("id").alias("component_id")))
    return done.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
