r"""Cheapest edits that give a conversation the shape ``(system? (user assistant)+)?``, by a checkpointed dynamic program.

A row is kept (0), given the other role of user and assistant (2) or deleted (3, must be for blank and duplicate rows); empty
turns are inserted anywhere (2); a truncated row that stays adds 1. Of the cheapest edits those count whose letters D, I, K, R
are least in ASCII order.

1. *Rows in order.* All rows get one dense number in the order of conversation, turn, role and text (ranges, not a window). A row
   is then one code: the initial of its role and its first fault.
2. *Checkpoints.* A conversation of n rows is cut into blocks of the square root of n. A block's rows make one matrix: the least
   cost from each of the four states to each (nothing yet, after system, after user, after assistant). From the matrices, about sqrt(n) of
   them, the backward costs at the ends of the blocks follow; only these are stored.
3. *Forward.* Each block computes its inner backward costs again from its checkpoint and walks the least tight letters from each of
   the four states it may be entered in. The states at the block ends, again sqrt(n) of them, say which of the four walks is true.

No task holds more of a conversation than sqrt(n) codes or checkpoints, so one that has a third of all rows is many tasks. Blocks of one
batch are stepped through together in numpy. Only the digest of a whole conversation reads its rows in one stream, because a
SHA-256 has no other way; it keeps nothing but its state (and the letters, which are a cell of the result).

Cases: null role or text counts as one space, and a role is told by its first letter. Rows come by turn (nulls first), then role and text, so ties and repeated
rows have one result. Rows with a null id form one conversation. A conversation without rows costs nothing. An empty table gives empty
frames. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import cut, shuffle_parts
from rollcall.operators.lookup import attach
from rollcall.operators.numbering import number_rows

BLANKS = " \t\n\x0b\f\r"
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = "sua"
_FAR = 1 << 50
#: Codes of the blocks that are walked in step at once.
_IN_STEP = 1 << 18
_LETTERS = b"DIKR"
#: State after an inserted or re-roled turn: assistant after user, else user.
_NEXT = np.array([USER, USER, ASSISTANT, USER])


def _costs() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Insertions alone [from][to]; insertions and one row [code][from][to]; the same row kept: its cost and state [code][from]."""
    free = np.full((4, 4), _FAR)
    for a in range(4):
        free[a, a], free[a, _NEXT[a]] = 0, 2
        free[a, _NEXT[_NEXT[a]]] = min(4, free[a, _NEXT[_NEXT[a]]])
    keep = np.full((16, 4), _FAR)
    state = np.zeros((16, 4), np.int64)
    row = np.full((16, 4, 4), _FAR)
    for code in range(16):
        initial, fault = code % 4, code // 4
        for a in range(4):
            row[code, a, a] = 3
            if fault in (BLANK, DUPLICATE):
                continue
            late = int(fault == TRUNCATED)
            row[code, a, _NEXT[a]] = min(row[code, a, _NEXT[a]], 2 + late)
            to = (SYSTEM, USER, ASSISTANT, -1)[initial]
            if to == SYSTEM and a == START or to in (USER, ASSISTANT) and _NEXT[a] == to:
                keep[code, a], state[code, a] = late, to
                row[code, a, to] = min(row[code, a, to], late)
    return free, _after(free[None], row), keep, state


def _after(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least cost of ``a`` and then ``b``."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), _FAR)


_FREE, _ROW, _KEEP, _KEPT = _costs()
#: Backward cost after the last row: nothing yet and after assistant may end.
_END = (_FREE + np.array([0, _FAR, _FAR, 0])).min(1)


class Repair(NamedTuple):
    """``facts``: one row per conversation with rows; ``edits``: one per edit (key, block, place, edit, role, text)."""

    facts: DataFrame
    edits: DataFrame


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) with seeded faults: by CRC-32 of id and turn modulo 20, 0 drops the row, 1 empties its text, 2 takes
    out its ends of sentences, 3 repeats it, 4 makes it the user's; nulls count as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    fate = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col(text_col), space)
    return rows.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.when(fate == 4, "user").otherwise(F.coalesce(F.col(role_col), space)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with ``seq``, their place among all rows, and ``key``, their conversation as text without null."""
    space = F.lit(" ")
    own = rows.select(
        F.when(F.col("conv").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv").cast("string"))).alias("key"),
        "conv",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.monotonically_increasing_id().alias("row"),  # spreads equal rows over the ranges
    )
    return number_rows(own, ["conv", "turn", "role", "text", "row"], "seq", 0).drop("row")


def codes(rows: DataFrame) -> DataFrame:
    """Stored (key, seq, turn, conv, fault, code) of placed rows; first faults only."""
    told = F.rtrim("text", F.lit(BLANKS))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    narrow = cut(
        rows.select(
            "key",
            "seq",
            "turn",
            "conv",
            digest.alias("digest"),
            F.when(F.col("role") == "", 0).otherwise(F.instr(F.lit(_INITIALS), F.left("role", F.lit(1)))).alias("initial"),
            F.when(told == "", BLANK).when(~F.right(told, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NO_FAULT).alias("fault"),
        )
    )
    several = narrow.groupBy("key", "digest").agg(F.min("seq").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = (F.col("fault") != BLANK) & (F.col("seq") > F.col("first"))
    fault = F.when(again, DUPLICATE).otherwise(F.col("fault"))
    initial = F.when(F.col("initial") == 0, 3).otherwise(F.col("initial") - 1)
    return cut(
        attach(narrow, several, ["key", "digest"]).select("key", "seq", "turn", "conv", fault.alias("fault"), (initial + 4 * fault).cast("tinyint").alias("code"))
    )


def counts(coded: DataFrame) -> DataFrame:
    """Per conversation: conv, n, first (its first seq), gaps, blank, duplicate, truncated. A turn's rows are added up first."""
    kinds = {"blank": BLANK, "duplicate": DUPLICATE, "truncated": TRUNCATED}
    turns = coded.groupBy("key", "turn").agg(
        F.min("conv").alias("conv"),
        F.count("*").alias("n"),
        F.min("seq").alias("first"),
        *[F.count_if(F.col("fault") == k).alias(name) for name, k in kinds.items()],
    )
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    return turns.groupBy("key").agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.min("first").alias("first"), span.alias("gaps"), *[F.sum(c).alias(c) for c in kinds]
    )


def blocks(coded: DataFrame, facts: DataFrame) -> DataFrame:
    """Stored (key, block, head, codes): the rows of a conversation in blocks of the square root of their number."""
    own = attach(coded.select("key", "seq", "code"), facts.select("key", "n", "first"), ["key"])
    at = (F.col("seq") - F.col("first")) / F.ceil(F.sqrt("n"))
    inside = F.sort_array(F.collect_list(F.struct("seq", "code")))
    packed = own.withColumn("block", F.floor(at)).groupBy("key", "block").agg(F.min("seq").alias("head"), inside.alias("rows"))
    return cut(packed.select("key", "block", "head", F.transform("rows", lambda r: r["code"]).alias("codes")))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each list begins (one place more at the end)."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[at[0] : at[-1]], at - at[0]


def _batches(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Batches cut where the lists of column ``name`` hold ``_IN_STEP`` values, one row at least."""
    for b in batches:
        _, at = _lists(b.column(name))
        lo = 0
        while lo < len(at) - 1:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _IN_STEP, "right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi


def _by_length(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks, long ones first, and how many of them have more than t rows, for each t."""
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    longest = int(size.max()) if len(size) else 0
    return order, np.searchsorted(-size[order], -np.arange(longest), "left")


def matrices(packed: DataFrame) -> DataFrame:
    """(key, block, matrix, illegal, opens, closes): a block's costs from state to state and what its roles say about each other."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches, "codes"):
            code, at = _lists(b.column("codes"))
            order, alive = _by_length(at)
            total = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, _FAR), (len(order), 4, 4)).copy()
            for t, m in enumerate(alive):
                total[:m] = _after(_ROW[code[at[1:][order[:m]] - 1 - t]], total[:m])
            out = np.empty_like(total)
            out[order] = total
            initial = code % 4
            bad = np.zeros(len(code) + 1, np.int64)
            pair = 4 * initial[:-1] + initial[1:]
            bad[2:] = np.cumsum(~np.isin(pair, (4 * 0 + 1, 4 * 1 + 2, 4 * 2 + 1)))
            inner = bad[at[1:]] - bad[at[:-1] + 1]
            yield pa.record_batch(
                {
                    "key": b.column("key"),
                    "block": b.column("block"),
                    "matrix": pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32) * 16), pa.array(out.ravel())),
                    "illegal": pa.array(inner),
                    "opens": pa.array(initial[at[:-1]].astype(np.int32)),
                    "closes": pa.array(initial[at[1:] - 1].astype(np.int32)),
                }
            )

    return packed.select("key", "block", "codes").mapInArrow(read, "key string, block long, matrix array<long>, illegal long, opens int, closes int")


def checkpoints(found: DataFrame) -> DataFrame:
    """(key, ends, cost, illegal) per conversation: backward costs at the end of each block, in one list of fours."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("parts")
            at = column.offsets.to_numpy().astype(np.int64)
            parts = column.values.slice(at[0], at[-1] - at[0])
            at = at - at[0]
            matrix = parts.field("matrix").flatten().to_numpy().reshape(-1, 4, 4)
            order, alive = _by_length(at)
            ends = np.zeros((len(parts), 4), np.int64)
            now = np.broadcast_to(_END, (len(order), 4)).copy()
            for t, m in enumerate(alive):
                place = at[1:][order[:m]] - 1 - t
                ends[place] = now[:m]
                now[:m] = np.minimum((matrix[place] + now[:m, None, :]).min(2), _FAR)
            cost = np.empty(len(order), np.int64)
            cost[order] = now[:, START]
            opens, closes = parts.field("opens").to_numpy(), parts.field("closes").to_numpy()
            bad = parts.field("illegal").to_numpy().copy()
            seam = np.ones(len(parts), bool)
            seam[at[:-1]] = False
            seam = np.flatnonzero(seam)
            bad[seam] += ~np.isin(4 * closes[seam - 1] + opens[seam], (1, 6, 9))
            yield pa.record_batch(
                {
                    "key": b.column("key"),
                    "ends": pa.ListArray.from_arrays(pa.array((at * 4).astype(np.int32)), pa.array(ends.ravel())),
                    "cost": pa.array(cost),
                    "illegal": pa.array(np.add.reduceat(bad, at[:-1]) if len(parts) else bad),
                }
            )

    parts = F.sort_array(F.collect_list(F.struct("block", "matrix", "illegal", "opens", "closes")))
    per = found.groupBy("key").agg(parts.alias("parts"))
    return cut(per.mapInArrow(read, "key string, ends array<long>, cost long, illegal long"))


def walk(code: np.ndarray, at: np.ndarray, ends: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Least tight letters of blocks from each entry state, and the states they end in."""
    order, alive = _by_length(at)
    size = np.diff(at)[order]
    start = at[:-1][order]
    back = np.zeros((len(code) + len(order), 4), np.int64)  # backward costs: one place more a block than rows
    base = start + order
    back[base + size] = ends[order]
    for t, m in enumerate(alive):
        row = start[:m] + size[:m] - 1 - t
        rest = back[base[:m] + size[:m] - t]
        back[base[:m] + size[:m] - 1 - t] = np.minimum((_ROW[code[row]] + rest[:, None, :]).min(2), _FAR)
    state = np.broadcast_to(np.arange(4), (len(order), 4)).copy()
    told = []

    def insert(now: np.ndarray, here: np.ndarray, free: np.ndarray) -> np.ndarray:
        """Where inserting is tight; moves the states on."""
        own = np.take_along_axis(here, now, 1)
        into = _NEXT[now]
        tight = free & (own == 2 + np.take_along_axis(here, into, 1))
        now[tight] = into[tight]
        return tight

    for t, m in enumerate(alive):
        now, c = state[:m], code[start[:m] + t][:, None]
        here, rest = back[base[:m] + t], back[base[:m] + t + 1]
        open_ = np.ones((m, 4), bool)
        for _ in range(3):
            own = np.take_along_axis(here, now, 1)
            away = open_ & (own == 3 + np.take_along_axis(rest, now, 1))
            letter = np.where(away, _LETTERS[0], 0).astype(np.uint8)
            open_ &= ~away
            put = insert(now, here, open_)
            letter[put] = _LETTERS[1]
            kept = open_ & ~put & (own == _KEEP[c, now] + np.take_along_axis(rest, _KEPT[c, now], 1))
            letter[kept] = _LETTERS[2]
            other = open_ & ~put & ~kept
            letter[other] = _LETTERS[3]
            now[:] = np.where(kept, _KEPT[c, now], np.where(other, _NEXT[now], now))
            open_ &= put
            told.append((m, letter))
            if not open_.any():
                break
    here = ends[order]
    for _ in range(2):
        put = insert(state, here, np.broadcast_to(last[order][:, None], (len(order), 4)))
        told.append((len(order), np.where(put, _LETTERS[1], 0).astype(np.uint8)))
    letters: list[list[bytes]] = [[b""] * 4 for _ in order]
    grid = np.zeros((len(told), len(order), 4), np.uint8) if len(told) * len(order) <= 1 << 22 else None
    if grid is not None:
        for k, (m, letter) in enumerate(told):
            grid[k, :m] = letter
    for i, block in enumerate(order):
        column = grid[:, i] if grid is not None else np.stack([x[i] for m, x in told if i < m])
        letters[block] = [column[:, q][column[:, q] > 0].tobytes() for q in range(4)]
    exits = np.empty((len(order), 4), np.int64)
    exits[order] = state
    return exits, letters


def walks(packed: DataFrame, checked: DataFrame) -> DataFrame:
    """Stored (key, block, exits, letters): each block's walks from all four states."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches, "codes"):
            code, at = _lists(b.column("codes"))
            ends = _lists(b.column("end"))[0].reshape(-1, 4)
            exits, letters = walk(code, at, ends, b.column("last").to_numpy(zero_copy_only=False))
            fours = pa.array(np.arange(len(exits) + 1, dtype=np.int32) * 4)
            yield pa.record_batch(
                {
                    "key": b.column("key"),
                    "block": b.column("block"),
                    "head": b.column("head"),
                    "codes": b.column("codes"),
                    "exits": pa.ListArray.from_arrays(fours, pa.array(exits.ravel().astype(np.int32))),
                    "letters": pa.ListArray.from_arrays(fours, pa.array([x.decode() for four in letters for x in four], pa.string())),
                }
            )

    n = F.size("ends") / 4
    end = checked.select("key", n.cast("long").alias("n"), F.posexplode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("block", "k"), "ends")
    end = end.select("key", F.col("block").cast("long").alias("block"), F.slice("ends", F.col("block") * 4 + 1, 4).alias("end"), (F.col("block") == F.col("n") - 1).alias("last"))
    both = packed.join(end, ["key", "block"]).select("key", "block", "head", "codes", "end", "last")
    return cut(both.mapInArrow(read, "key string, block long, head long, codes array<tinyint>, exits array<int>, letters array<string>"))


def spelled(walked: DataFrame) -> DataFrame:
    """(key, block, place, edit, seq, given): the edits of the true walks; ``given`` is the role that an edit gives."""
    parts = F.sort_array(F.collect_list(F.struct("block", "exits")))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for exits in b.column("parts").to_pylist():
                now = [START]
                for part in exits[:-1]:
                    now.append(part["exits"][now[-1]])
                out.append(now)
            yield pa.record_batch({"key": b.column("key"), "entries": pa.array(out, pa.list_(pa.int32()))})

    per = walked.select("key", "block", "exits").groupBy("key").agg(parts.alias("parts"))
    entered = per.mapInArrow(entries, "key string, entries array<int>").select("key", F.posexplode("entries").alias("block", "state"))
    entered = entered.withColumn("block", F.col("block").cast("long"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ks, places, edits, seqs, given = [], [], [], [], [], []
            rows = zip(*[b.column(c).to_pylist() for c in ("key", "block", "head", "state", "codes", "letters")], strict=True)
            for key, block, head, state, code, letters in rows:
                i = 0
                for place, x in enumerate(letters):
                    role = None
                    if x in "IR":
                        state = int(_NEXT[state])
                        role = "user" if state == USER else "assistant"
                    elif x == "K":
                        state = (SYSTEM, USER, ASSISTANT)[code[i] % 4]
                    given.append(role)
                    seqs.append(None if x == "I" else head + i)
                    i += x != "I"
                    places.append(place)
                    edits.append(x)
                keys += [key] * len(letters)
                ks += [block] * len(letters)
            yield pa.record_batch(
                {
                    "key": pa.array(keys, pa.string()),
                    "block": pa.array(ks, pa.int64()),
                    "place": pa.array(places, pa.int32()),
                    "edit": pa.array(edits, pa.string()),
                    "seq": pa.array(seqs, pa.int64()),
                    "given": pa.array(given, pa.string()),
                }
            )

    true = walked.join(entered, ["key", "block"]).select("key", "block", "head", "state", "codes", F.get("letters", "state").alias("letters"))
    return true.mapInArrow(spell, "key string, block long, place int, edit string, seq long, given string")


def repair(rows: DataFrame) -> Repair:
    """Facts and edits of conversations (conv, turn, role, text).

    ``facts``: key, conv, n, gaps, blank, duplicate, truncated, illegal, cost. ``edits``: key, block and place give their order; role and
    text are those of the row that an edit leaves (null if it is deleted).
    """
    whole = placed(rows)
    coded = codes(whole)
    facts = cut(counts(coded))
    packed = blocks(coded, facts)
    checked = checkpoints(matrices(packed))
    edits = spelled(walks(packed, checked))
    text = whole.select("seq", "role", "text")
    joined = edits.filter("edit IN ('K', 'R')").join(text, "seq").select(
        "key", "block", "place", "edit", F.coalesce("given", "role").alias("role"), "text"
    )
    others = edits.filter("edit NOT IN ('K', 'R')").select(
        "key", "block", "place", "edit", F.col("given").alias("role"), F.when(F.col("edit") == "I", "").alias("text")
    )
    return Repair(attach(facts, checked.select("key", "cost", "illegal"), ["key"]), joined.unionByName(others))


def digests(edits: DataFrame) -> DataFrame:
    """(key, audit, repaired_sha256) of each conversation, read as one sorted stream."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        now, audit, digest, some = None, [], hashlib.sha256(), False
        for b in batches:
            done = []
            for key, edit, role, text in zip(*[b.column(c).to_pylist() for c in ("key", "edit", "role", "text")], strict=True):
                if key != now:
                    if now is not None:
                        done.append((now, "".join(audit), digest.hexdigest()))
                    now, audit, digest, some = key, [], hashlib.sha256(), False
                audit.append(edit)
                if edit != "D":
                    digest.update((("\n" if some else "") + f"{role}:{text}").encode())
                    some = True
            if done:
                yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*done, strict=True)], schema=schema)
        if now is not None:
            yield pa.record_batch([pa.array([x], pa.string()) for x in (now, "".join(audit), digest.hexdigest())], schema=schema)

    order = ["key", "block", "place"]
    sorted_ = edits.repartition(shuffle_parts(edits.sparkSession), "key").sortWithinPartitions(*order)
    return sorted_.select("key", "edit", "role", "text").mapInArrow(read, "key string, audit string, repaired_sha256 string")
