"""Documents linked by the Jaccard similarity of their shingle sets, by an exact prefix index that skips.

1. *Equal sets* are one class; a class gets one set of answers for all its documents.
2. *Index.* The tokens of a class are put in one global order, rare ones first, and those of the prefix (a pair at the
   threshold shares one) become entries (token, class, size, position). The order comes from hashed counts of all tokens
   of all documents in ``SKETCH`` buckets; any order gives the same links, a good one gives short lists.
3. *Skipping by block.* A list of more than ``SHORT`` entries is laid out in blocks by size class and position. Two blocks
   whose sizes are too far apart, or where the tokens left after their positions cannot reach the needed overlap, are
   never opened. Short lists are paired directly, under the same tests for each pair.
4. *Answers from similar sets.* A set that turned out to link with another one takes over all that is known of it: both
   carry one label, and no pair of one label is looked at again. Up to ``ROUNDS`` passes over the long lists test each set with
   ``LEADERS`` others of its rows, which joins the groups of near copies after a linear number of tests. Then all
   block pairs that still hold two labels are opened, so that no link is lost.
   ``components`` works so: the links inside a group that has one label are not looked for. ``links`` and ``link_counts``
   leave this step out and test every pair of the opened blocks, so they give all links, at a cost of up to the square of a group.
5. *Parity.* A class has a bitmap in which each of its tokens turns one bit over. Every bit in which two bitmaps differ stands for a
   token that only one of the sets holds, so two sets whose bitmaps differ in more than a seventh of their sizes together
   cannot link; only pairs that pass go on. It is a bound, not a sketch: it drops no link.
6. A tested pair is decided on the whole sets: 100 * intersection >= 75 * union.

Blocks and their pairs have bounded size (``BLOCK``), so a token that a third of all rows share is many small tasks. Sets are
kept as 64-bit shingle hashes; only sets of pairs that pass 5, or that meet in long lists, are stored.

Cases: null and empty texts have no shingles, link with nothing and are their own component. Repeated rows are one class.
A null id counts as missing: a component's id is the smallest id that is not null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm import fuse, screen, words
from rollcall.llm.common import cut, free_name, parts_of, shuffle_parts, slices, snug, stored, tidy, utf8
from rollcall.llm.components import stars
from rollcall.llm.set_pairs import BROADCAST_PAIRS, confirmed
from rollcall.operators.lookup import attach

SHINGLE = 5
#: Least similarity in percent; the tests of sizes and places below have it as 3/4.
ALIKE = 75
SKETCH_BITS = 20
SKETCH_PARTS = 64
SHORT = 8
BLOCK = 1024
#: Rounds over the long lists at most, and leaders that a set is tested with in one; a round is the last one if fewer than ``STALE`` of its pairs link.
ROUNDS = 5
LEADERS = 4
STALE = 0.05
_ENTRY = "token long, cid long, n int, pos int"


def token_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for lo, hi in slices(column):
        found, at = words.shingles(*words.words(*utf8(column[lo:hi])), SHINGLE)
        for i in range(hi - lo):
            yield np.unique(found[at[i] : at[i + 1]])


def class_key(tokens: np.ndarray) -> tuple[int, int]:
    """128-bit key of a set, whatever its order."""
    a = words.mix(tokens * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = np.bitwise_xor.reduce(words.mix(tokens + np.uint64(0x632BE59BD9B4E019)), initial=np.uint64(len(tokens)))
    return int(a.view(np.int64)), int(b.view(np.int64))


def prefix_length(n: int) -> int:
    return n - -(-3 * n // 4) + 1 if n else 0


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of a set in longs, of two to four bits a token; a longer one folds to the next shorter by an exclusive or of its halves."""
    size = 64
    while size < 2 * len(tokens):
        size *= 2
    odd = np.bincount((words.mix(tokens) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def facts(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Stored (id, n, k1, k2) of every row, and the hashed token counts of all rows."""
    kind = dict(docs.dtypes)["id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        schema = None
        for b in batches:
            rows = []
            for tokens in token_sets(b.column("text")):
                np.add.at(counts, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                rows.append((len(tokens), *class_key(tokens)))
            n, k1, k2 = zip(*rows, strict=True) if rows else ((), (), ())
            out = pa.record_batch(
                {"id": b.column("id"), "n": pa.array(n, pa.int32()), "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "part": pa.nulls(len(n), pa.int32()), "counts": pa.nulls(len(n), pa.binary())}
            )
            schema = out.schema
            yield out
        if schema is not None:
            yield from _packed(counts, schema)

    def _packed(counts: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        parts = counts.reshape(SKETCH_PARTS, -1)
        cols = [pa.nulls(SKETCH_PARTS, f.type) for f in schema]
        cols[4] = pa.array(range(SKETCH_PARTS), pa.int32())
        cols[5] = pa.array([press.compress(p.tobytes()) for p in parts], pa.binary())
        yield pa.record_batch(cols, schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unpress = zstandard.ZstdDecompressor()
        for b in batches:
            for part, counts in zip(b.column("part").to_pylist(), b.column("counts").to_pylist(), strict=True):
                more = np.frombuffer(unpress.decompress(counts), np.int64)
                total[part] = total[part] + more if part in total else more
        press = zstandard.ZstdCompressor(level=1)
        yield pa.record_batch(
            {"part": pa.array(list(total), pa.int32()), "counts": pa.array([press.compress(x.tobytes()) for x in total.values()], pa.binary())}
        )

    read_rows = cut(docs.mapInArrow(tidy(read), f"id {kind}, n int, k1 long, k2 long, part int, counts binary"))
    sketched = read_rows.filter("part IS NOT NULL").select("part", "counts", F.spark_partition_id().alias("task"))
    for keys in (("part", "task"), ("part",)):  # first within some tasks' results, then all of a part
        salt = [F.pmod(F.hash(F.col(k)), F.lit(64)) for k in keys[1:]]
        sketched = sketched.repartition(shuffle_parts(docs.sparkSession), "part", *salt).select("part", "counts").mapInArrow(tidy(add), "part int, counts binary").withColumn("task", F.lit(0))
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for row in sketched.collect():
        counts[row["part"]] += np.frombuffer(zstandard.ZstdDecompressor().decompress(row["counts"]), np.int64)
    return read_rows.filter("part IS NULL").drop("part", "counts"), counts.ravel()


def classes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """Stored (cid, k1, k2, n, id, prefix, bits): distinct sets with their smallest id, ordered prefix and ``parity``."""
    held = docs.sparkSession.sparkContext.broadcast(counts)
    kind = dict(docs.dtypes)["id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, prefixes, bits = [], [], [np.empty(0, np.int64)]
            for tokens in token_sets(b.column("text")):
                common = held.value[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((tokens, common))[: prefix_length(len(tokens))]
                prefixes.append(tokens[order].tobytes())
                bits.append(parity(tokens))
                rows.append((len(tokens), *class_key(tokens)))
            n, k1, k2 = zip(*rows, strict=True) if rows else ((), (), ())
            at = pa.array(np.cumsum([len(x) for x in bits]), pa.int32())
            yield pa.record_batch(
                {
                    "id": b.column("id"),
                    "n": pa.array(n, pa.int32()),
                    "k1": pa.array(k1, pa.int64()),
                    "k2": pa.array(k2, pa.int64()),
                    "prefix": pa.array(prefixes, pa.binary()),
                    "bits": pa.ListArray.from_arrays(at, pa.array(np.concatenate(bits))),
                }
            )

    return cut(
        docs.mapInArrow(tidy(read), f"id {kind}, n int, k1 long, k2 long, prefix binary, bits array<long>")
        .filter("n > 0")
        .groupBy("k1", "k2", "n")
        .agg(F.min("id").alias("id"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
        .withColumn("cid", F.monotonically_increasing_id())
    )


def repeated(found: DataFrame) -> DataFrame:
    """Stored column ``key``: prefix tokens that two classes have at least.

    Tokens cross the shuffle as packed arrays, each once or twice for a batch of classes, so a token that very many classes
    share is no more in one task than there are batches; counts and classes stay behind.
    """
    parts = shuffle_parts(found.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, _ = utf8(b.column("prefix"))
            tokens, times = np.unique(np.frombuffer(raw.tobytes(), np.uint64), return_counts=True)
            tokens = np.concatenate((tokens, tokens[times > 1]))
            part = (words.mix(tokens) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            ends = np.cumsum(np.bincount(part, minlength=parts))
            cells = [x.tobytes() for x in np.split(tokens[order], ends[:-1])]
            yield pa.record_batch({"part": pa.array(range(parts), pa.int32()), "tokens": pa.array(cells, pa.binary())})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.uint64)]
        for b in batches:
            held.append(np.frombuffer(utf8(b.column("tokens"))[0].tobytes(), np.uint64))
        every = np.sort(np.concatenate(held))
        yield pa.record_batch({"key": pa.array(np.unique(every[1:][every[1:] == every[:-1]]).view(np.int64))})

    packed = found.select("prefix").mapInArrow(tidy(pack), "part int, tokens binary")
    return snug(packed.repartitionById(parts, F.col("part")).select("tokens").mapInArrow(tidy(meet), "key long"))


def entries(found: DataFrame) -> DataFrame:
    """Index entries of tokens that two classes share at least, with the length of their list.

    A filter of the repeated tokens keeps the others from being written (up to ``screen.BROADCAST_BYTES``; beyond it the join does).
    """
    shared = repeated(found)
    n = shared.count()
    few = n * 9 // 8 * 1.5 <= screen.BROADCAST_BYTES
    shards = max(1, -(-n // screen.SHARD_KEYS))
    held = None
    if few:
        keyed = shared.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
        made = {r["shard"]: (*tuple(r)[1:4], bytes(r["table"])) for r in screen.filters(keyed, ["shard"]).collect()}
        held = found.sparkSession.sparkContext.broadcast(made)

    def met(tokens: np.ndarray) -> np.ndarray:
        if held is None:
            return np.ones(len(tokens), bool)
        keep = np.zeros(len(tokens), bool)
        shard = tokens % shards
        for k, f in held.value.items():
            own = np.flatnonzero(shard == k)
            keep[own] = fuse.might_hold(tokens[own].view(np.uint64), *f)
        return keep

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = utf8(b.column("prefix"))
            tokens = np.frombuffer(raw.tobytes(), np.int64)
            size = np.diff(at) // 8
            row = np.repeat(np.arange(len(size)), size)
            pos = (np.arange(len(row)) - (at[:-1] // 8)[row]).astype(np.int32)
            keep = np.flatnonzero(met(tokens))
            yield pa.record_batch(
                {
                    "token": pa.array(tokens[keep]),
                    "cid": pa.array(b.column("cid").to_numpy()[row[keep]]),
                    "n": pa.array(b.column("n").to_numpy()[row[keep]]),
                    "pos": pa.array(pos[keep]),
                }
            )

    every = found.select("prefix", "cid", "n").mapInArrow(tidy(read), _ENTRY)
    if few:
        every = snug(every)
    else:
        every = attach(every, shared.select(F.col("key").alias("token")), ["token"], "inner")
    lengths = every.groupBy("token").agg(F.count("*").alias("cnt")).filter("cnt > 1")
    return snug(attach(every, lengths, ["token"], "inner").select("token", "cid", "n", "pos", "cnt"))


def _can_link(a: str, b: str) -> Column:
    """Size and position tests of two entries of one list."""
    return F.expr(
        f"4L * least({a}.n, {b}.n) >= 3L * greatest({a}.n, {b}.n)"
        f" AND 7L * (1 + least({a}.n - {a}.pos - 1, {b}.n - {b}.pos - 1)) >= 3L * ({a}.n + {b}.n)"
    )


def _alike(a: str, b: str) -> Column:
    """Parity test of two sets (n, bits): false only if they cannot link.

    Sets that may link by size have bitmaps of one length, or one of twice the other, which is folded; others give null, no pair either.
    """
    x, y = (
        f"IF(size({p}.bits) > size({q}.bits), zip_with(slice({p}.bits, 1, size({q}.bits)), slice({p}.bits, size({q}.bits) + 1, size({q}.bits)), (g, h) -> g ^ h), {p}.bits)"
        for p, q in ((a, b), (b, a))
    )
    return F.expr(f"7L * aggregate(zip_with({x}, {y}, (g, h) -> bit_count(g ^ h)), 0, (g, h) -> g + h) <= {a}.n + {b}.n")


def maps_of(found: DataFrame, pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Stored (cid, k1, k2, n, bits) of the classes in ``pairs`` (a, b) and ``blocks``."""
    ids, n = stored(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).union(blocks.select("cid")).distinct())
    ids = ids.coalesce(parts_of(n))
    few = n <= BROADCAST_PAIRS  # then the classes stay where they are stored
    return snug(found.select("cid", "k1", "k2", "n", "bits").join(F.broadcast(ids) if few else ids, "cid", "left_semi"))


def likely(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that pass the parity test of ``maps`` (cid, n, bits)."""
    for end in "ab":
        pairs = attach(pairs, maps.select(F.col("cid").alias(end), F.struct("n", "bits").alias(f"_{end}")), [end], "inner")
    return pairs.filter(_alike("_a", "_b")).select("a", "b")


def short_pairs(index: DataFrame) -> DataFrame:
    few = index.filter(F.col("cnt") <= SHORT)
    a, b = few.alias("a"), few.alias("b")
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.cid") < F.col("b.cid")) & _can_link("a", "b"))
    return met.select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct()


def in_blocks(index: DataFrame) -> DataFrame:
    """Entries of long lists with their block: size class, eighth of the set where the token stands, and a share of at most
    about ``BLOCK`` entries."""
    return index.filter(F.col("cnt") > SHORT).withColumns(
        {
            "size": F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int"),
            "at": F.floor(8 * F.col("pos") / F.col("n")).cast("int"),
            "share": F.pmod(F.xxhash64("cid"), F.ceil(F.col("cnt") / BLOCK)).cast("int"),
        }
    ).withColumn("block", F.concat_ws(":", "size", "at", "share"))


def block_pairs(blocks: DataFrame, labelled: bool) -> DataFrame:
    """Pairs (token, one, two) of blocks that cannot be skipped."""
    label = [F.min("label").alias("low"), F.max("label").alias("high")] if labelled else []
    heads = blocks.groupBy("token", "block").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("p0"), F.count("*").alias("m"), *label
    )
    a, b = heads.alias("a"), heads.alias("b")
    open_ = F.expr(
        "a.token = b.token AND a.block <= b.block AND (a.block < b.block OR a.m > 1)"
        " AND 4L * b.n1 >= 3L * a.n0 AND 4L * a.n1 >= 3L * b.n0"
        " AND 7L * least(a.n1 - a.p0, b.n1 - b.p0) >= 3L * (a.n0 + b.n0)"
    )
    if labelled:
        open_ = open_ & F.expr("least(a.low, b.low) < greatest(a.high, b.high)")
    return a.join(b, open_).select("a.token", F.col("a.block").alias("one"), F.col("b.block").alias("two"))


def partnered(blocks: DataFrame, opened: DataFrame) -> DataFrame:
    """Entries that pass the tests with some entry of a block they meet."""
    ways = F.array(F.struct("one", "two"), F.struct(F.col("two").alias("one"), F.col("one").alias("two")))
    meets = opened.select("token", F.explode(ways).alias("way")).select("token", "way.*").distinct()
    own = F.struct("cid", "n", "pos")
    a = blocks.join(meets.withColumnRenamed("one", "block"), ["token", "block"]).withColumn("x", own)
    b = blocks.select(F.col("token").alias("tok"), F.col("block").alias("other"), own.alias("y"))
    some = a.join(b, F.expr("token = tok AND two = other AND x.cid <> y.cid") & _can_link("x", "y"), "left_semi")
    return some.drop("two", "x").distinct()


def leader_pairs(blocks: DataFrame, turn: int) -> DataFrame:
    """Up to ``LEADERS`` pairs (a, b) for each set: with leaders of other labels from its rows, each in a random order of its own.

    A row's leaders are one aggregate per token and size class; of all rows of a set one leader per order is taken, so the pairs of a group
    grow with its members, not with their tokens.
    """
    ways = range(LEADERS)
    own = [F.col(c) for c in ("label", "cid", "n", "pos")]
    order = [F.struct(F.xxhash64("label", F.lit(turn * LEADERS + k)).alias("h"), *own) for k in ways]
    leaders = blocks.groupBy("token", "size").agg(*[F.min(o).alias(f"lead{k}") for k, o in enumerate(order)])
    met = attach(blocks.select("token", "size", *own, F.struct(*own).alias("y")), leaders, ["token", "size"], "inner")
    fits = lambda k: (F.col("label") != F.col(f"lead{k}.label")) & _can_link(f"lead{k}", "y")
    one = met.groupBy("cid").agg(*[F.min(F.when(fits(k), F.struct(f"lead{k}.h", F.col(f"lead{k}.cid").alias("cid")))).alias(f"best{k}") for k in ways])
    pairs = one.select("cid", F.explode(F.array_distinct(F.array(*[F.col(f"best{k}.cid") for k in ways]))).alias("other")).filter("other IS NOT NULL")
    return pairs.select(F.least("cid", "other").alias("a"), F.greatest("cid", "other").alias("b")).distinct()


def open_pairs(blocks: DataFrame, maps: DataFrame) -> DataFrame:
    """Entry pairs of different labels in all block pairs that cannot be skipped, as far as they pass the parity test of ``maps``."""
    pairs = block_pairs(blocks, labelled=True)
    e = attach(blocks.select("token", "block", "cid", "n", "pos", "label"), maps.select("cid", "bits"), ["cid"], "inner")
    first = pairs.join(e.withColumnRenamed("block", "one"), ["token", "one"])
    first = first.select("token", "one", "two", F.struct("cid", "n", "pos", "label", "bits").alias("x"))
    second = e.select("token", F.col("block").alias("two"), F.struct("cid", "n", "pos", "label", "bits").alias("y"))
    a, b = first.alias("f"), second.alias("s")
    met = a.join(
        b,
        F.expr("f.token = s.token AND f.two = s.two AND f.x.label <> s.y.label AND (f.one < f.two OR f.x.cid < s.y.cid)")
        & _can_link("f.x", "s.y")
        & _alike("f.x", "s.y"),
    )
    return met.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored (cid, tokens) of the ``wanted`` classes (cid, k1, k2)."""
    spark = docs.sparkSession
    filters = None
    if (n := wanted.count()) * 9 // 8 * 1.5 <= screen.BROADCAST_BYTES:
        shards = max(1, -(-n // screen.SHARD_KEYS))
        keys = wanted.select(F.col("k1").alias("key"), F.pmod("k1", F.lit(shards)).cast("int").alias("shard"))
        made = {r["shard"]: (*tuple(r)[1:4], bytes(r["table"])) for r in screen.filters(keys, ["shard"]).collect()}
        filters = spark.sparkContext.broadcast((shards, made))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for tokens in token_sets(b.column("text")):
                k1, k2 = class_key(tokens)
                if filters is not None:
                    shards, held = filters.value
                    f = held.get(k1 % shards)
                    if f is None or not fuse.might_hold(np.array([k1]).view(np.uint64), *f)[0]:
                        continue
                rows.append((k1, k2, tokens.tobytes()))
            k1, k2, tokens = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch({"k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "tokens": pa.array(tokens, pa.binary())})

    read_sets = docs.mapInArrow(tidy(read), "k1 long, k2 long, tokens binary").groupBy("k1", "k2").agg(F.first("tokens").alias("tokens"))
    return cut(read_sets.join(wanted, ["k1", "k2"]).select("cid", "tokens"))


def _label(blocks: DataFrame, star: DataFrame | None) -> DataFrame:
    if star is None:
        return blocks.withColumn("label", F.col("cid"))
    names = star.select(F.col("u").alias("cid"), F.col("v").alias("root"))
    return blocks.join(names, "cid", "left").withColumn("label", F.coalesce("root", "cid")).drop("root")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id``."""
    docs = _scan(docs, id_col, text_col)
    rows, counts = facts(docs)
    found = classes(docs, counts)
    index = entries(found)
    direct = snug(short_pairs(index))
    long_ = cut(in_blocks(index))
    opened = block_pairs(long_, labelled=False)
    blocks = snug(partnered(long_, opened))
    maps = maps_of(found, direct, blocks)
    direct = snug(likely(direct, maps))
    named = direct.select(F.col("a").alias("cid")).union(direct.select("b")).union(blocks.select("cid")).distinct()
    sets = sets_of(docs, snug(maps.select("cid", "k1", "k2").join(named, "cid", "left_semi")))

    star = None
    for turn in range(ROUNDS):
        met = snug(leader_pairs(_label(blocks, star), turn))
        tested = likely(met, maps)
        edges = confirmed(tested if turn else tested.union(direct).distinct(), sets, ALIKE)
        star = stars(edges if star is None else edges.union(star))
        if edges.count() < STALE * met.count():
            break
    star = stars(confirmed(open_pairs(snug(_label(blocks, star)), maps), sets, ALIKE).union(star))

    own = found.select("cid", "k1", "k2", "id").join(star.select(F.col("u").alias("cid"), "v"), "cid", "left")
    own = own.withColumn("label", F.coalesce("v", "cid"))
    least = own.groupBy("label").agg(F.min("id").alias("component_id"))
    answer = attach(own, least, ["label"]).select("k1", "k2", "component_id")
    n = F.col("n").cast("long").alias("n_shingles")
    empty = rows.filter("n = 0").select("id", n, F.col("id").alias("component_id"))
    return attach(rows.filter("n > 0"), answer, ["k1", "k2"], "inner").select("id", n, "component_id").union(empty)


def _class_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored rows, classes and all links (u, v) between classes, each once; no pair is passed over for its label."""
    rows, counts = facts(docs)
    found = classes(docs, counts)
    index = entries(found)
    long_ = cut(in_blocks(index))
    blocks = snug(_label(partnered(long_, block_pairs(long_, labelled=False)), None))
    direct = snug(short_pairs(index))
    maps = maps_of(found, direct, blocks)
    pairs = cut(likely(direct, maps).union(open_pairs(blocks, maps)).distinct())
    named = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    sets = sets_of(docs, snug(found.select("cid", "k1", "k2").join(named, "cid", "left_semi")))
    return rows, found, confirmed(pairs, sets, ALIKE)


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The join itself: one row (``id_a``, ``id_b``) for each two different sets that link, each named by the smallest id of
    its documents (null, and then in ``id_b``, if none has one). Its size is that of the answer, quadratic in a group of near copies."""
    _, found, edges = _class_links(_scan(docs, id_col, text_col))
    a, b = (found.select(F.col("cid").alias(c), F.col("id").alias(f"id_{n}")) for c, n in (("u", "a"), ("v", "b")))
    one, two = F.least("id_a", "id_b"), F.greatest("id_a", "id_b")
    ends = edges.join(a, "u").join(b, "v")
    return ends.select(one.alias("id_a"), F.when(F.col("id_a").isNotNull() & F.col("id_b").isNotNull(), two).alias("id_b"))


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_shingles`` and ``n_links``, the number of other documents it links with (copies too)."""
    rows, found, edges = _class_links(_scan(docs, id_col, text_col))
    sizes = snug(rows.filter("n > 0").groupBy("k1", "k2").agg(F.count("*").alias("m")).join(found.select("k1", "k2", "cid"), ["k1", "k2"]))
    ends = edges.select(F.col("u").alias("cid"), F.col("v").alias("other")).union(edges.select("v", "u"))
    more = ends.join(sizes.select(F.col("cid").alias("other"), "m"), "other").groupBy("cid").agg(F.sum("m").alias("more"))
    total = (F.col("m") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links")
    answer = sizes.join(more, "cid", "left").select("k1", "k2", total)
    n = F.col("n").cast("long").alias("n_shingles")
    empty = rows.filter("n = 0").select("id", n, F.lit(0).cast("long").alias("n_links"))
    return rows.filter("n > 0").join(answer, ["k1", "k2"]).select("id", n, "n_links").union(empty)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id (null first), then of the smallest text digest.

    Rows that must not stay are few: their keys screen the table, and only rows that the filter holds are looked up. Of rows
    equal in id and text one stays. Texts without shingles all stay.
    """
    key, flag, tag = (free_name(docs.columns, x) for x in ("_key", "_suspect", "_tag"))
    own = F.struct(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("digest"))
    keyed = docs.withColumn(key, own)
    found = snug(components(keyed, key, text_col))
    stay = found.filter("id <=> component_id OR n_shingles = 0").groupBy("id").agg(F.count("*").alias("n"), F.max("n_shingles").alias("size"))
    go = found.filter("NOT id <=> component_id AND n_shingles > 0").select("id").union(stay.filter("n > 1 AND size > 0").select("id"))
    keys = snug(go.select(F.xxhash64("id").alias("key")).distinct())
    flagged = screen.flag(keyed, keys, F.xxhash64(F.col(key)), flag)
    rows = cut(flagged.filter(flag).withColumn(tag, F.monotonically_increasing_id()))
    kept = stay.select(F.col("id").alias(key), F.col("size").alias("_size"))
    judged = rows.select(key, tag).join(kept, key)
    first = judged.groupBy(key).agg(F.max(tag).alias(tag)).select(tag).union(judged.filter("_size = 0").select(tag)).distinct()
    again = rows.join(first, tag, "left_semi").select(*docs.columns)
    return flagged.filter(~F.col(flag)).select(*docs.columns).unionByName(again)
