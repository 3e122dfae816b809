r"""Importance resampling towards a target distribution: hashed n-gram weights, seeded noise, the best share drawn.

1. *Counts.* Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased; features are all words and all pairs of
   neighbouring words joined by a space, repeats counted; a feature's bucket is its CRC-32 modulo ``BUCKETS``. Each task adds
   up one array of ``BUCKETS`` counts, so nothing is grouped by feature and a frequent word is as cheap as a rare one.
2. *Weights from an array.* The gains of the buckets, ``BUCKETS`` numbers, are what the scan of the texts carries; a text's
   weight is the floored mean of the gains of its features. A score adds Gumbel noise that depends on seed and id alone.
3. *Cutoff.* A quantile sketch of the scores gives a bracket around the cutoff. The rows above it and inside it are counted
   exactly; if the cutoff is not inside, the bracket is widened and counted again, at last to all rows. Only the rows of the
   bracket are sorted to find the cutoff, the rows above only to number them; both in ranges, never in one task.

Cases: null and empty texts have no features and the weight 0. A null id is hashed as the word ``null`` and comes first among
equal scores. Rows that repeat an id are drawn each for itself; equal ones follow weight and number of features. An empty table, and a
share of no row, draw nothing; an empty target leaves weights that follow the counts of the raw table alone. Other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import cut, free_name, slices, utf8
from rollcall.operators.numbering import number_rows

BUCKETS = 10_000
#: Documents with fewer words are scored, but not drawn.
MIN_WORDS = 20
#: Half width of the first bracket, as a share of the rows; each further one is eight times as wide.
WIDTH = 1 / 256
#: Entries of the quantile sketch.
ACCURACY = 2_000
#: Words up to this many bytes are hashed in step, longer ones one by one.
IN_STEP = 64

_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("A") : ord("Z") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def _advance(c: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _CRC[(c ^ byte) & np.uint32(255)] ^ (c >> np.uint32(8))


def _zero_tables() -> np.ndarray:
    """[length][byte of the register][its value]: the register after so many zero bytes; registers add up by exclusive or."""
    now = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    out = [now]
    for _ in range(IN_STEP):
        now = _advance(now, np.uint32(0))
        out.append(now)
    return np.stack(out)


_ZEROS = _zero_tables()


def crc_of_words(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of each word."""
    order = np.argsort(-size, kind="stable")
    at, length = begin[order], size[order]
    crc = np.full(len(order), _ONES)
    first = int(np.searchsorted(-length, -IN_STEP, "left"))
    left = np.searchsorted(-length, -np.arange(int(length[first]) if first < len(length) else 0), "left")
    for j, end in enumerate(left):
        crc[first:end] = _advance(crc[first:end], data[at[first:end] + j])
    crc ^= _ONES
    for i in range(first):
        crc[i] = zlib.crc32(data[at[i] : at[i] + length[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def crc_of_pairs(data: np.ndarray, begin: np.ndarray, size: np.ndarray, crc: np.ndarray, left: np.ndarray) -> np.ndarray:
    """CRC-32 of word, space and next word, for the words numbered ``left``, from the CRCs of both."""
    spaced = _advance(crc[left] ^ _ONES, np.uint32(ord(" "))) ^ _ONES
    right = left + 1
    short = np.minimum(size[right], IN_STEP)
    out = crc[right].copy()
    for k in range(4):
        out ^= _ZEROS[short, k, (spaced >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(size[right] > IN_STEP):
        r = right[i]
        out[i] = zlib.crc32(data[begin[r] : begin[r] + size[r]], int(spaced[i]))
    return out


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, buckets of all pairs, the words that begin a pair, and per text the number of its first word."""
    ink = _WORD[data]
    data = _LOWER[data]
    before = np.zeros(len(data), bool)
    before[1:] = ink[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    begin = np.flatnonzero(ink & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = ink[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    size = np.flatnonzero(ink & ~after) + 1 - begin
    first = np.searchsorted(begin, at, "left")
    crc = crc_of_words(data, begin, size)
    inner = np.ones(len(begin), bool)
    inner[first[1:][first[1:] > 0] - 1] = False
    left = np.flatnonzero(inner)
    pairs = crc_of_pairs(data, begin, size, crc, left)
    return (crc % BUCKETS).astype(np.int64), (pairs % BUCKETS).astype(np.int64), left, first


def counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features in each bucket over all rows; one array per task, added up by bucket."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            text = b.column(0)
            for lo, hi in slices(text):
                words, pairs, _, _ = features(*utf8(text[lo:hi]))
                total += np.bincount(words, minlength=BUCKETS) + np.bincount(pairs, minlength=BUCKETS)
        met = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(met.astype(np.int32)), "n": pa.array(total[met])})

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(read, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target, one added to each count."""
    s, t = raw.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id``, ``n_features``, ``weight``) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(gain)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text")
            for lo, hi in slices(text):
                words, pairs, left, first = features(*utf8(text[lo:hi]))
                each = held.value[words]
                each[left] += held.value[pairs]
                total = np.concatenate(([0], np.cumsum(each)))
                n_words = np.diff(first)
                n = np.maximum(2 * n_words - 1, 0)
                weight = (total[first[1:]] - total[first[:-1]]) // np.maximum(n, 1)
                yield pa.record_batch({"id": b.column("id")[lo:hi], "n_features": pa.array(n), "weight": pa.array(weight)})

    return own.mapInArrow(read, f"id {dict(own.dtypes)['id']}, n_features long, weight long")


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def bracket(scores: DataFrame, want: int, n: int, width: float = WIDTH) -> tuple[float, float, int]:
    """Bounds (low, high) of the score at which ``want`` of ``n`` rows are reached, and the exact number of rows above ``high``.

    More than ``high``: certainly drawn; less than ``low``: certainly not. Both are checked by counting.
    """
    at = 1 - want / n
    while True:
        lo, hi = at - width, at + width
        low, high = scores.agg(F.percentile_approx("score", [max(lo, 0.0), min(hi, 1.0)], ACCURACY).alias("q")).first()["q"]
        low = low if lo > 0 else -np.inf
        high = high if hi < 1 else np.inf
        above, reached = scores.agg(
            F.count_if(F.col("score") > F.lit(float(high))), F.count_if(F.col("score") >= F.lit(float(low)))
        ).first()
        if above <= want <= reached:
            return float(low), float(high), above
        width *= 8


def draw(scored: DataFrame, percent: int, min_words: int = MIN_WORDS, width: float = WIDTH) -> DataFrame:
    """``scored`` (id, n_features, weight, score) with ``rank``: 1, 2, ... for the drawn rows by score, then id; else null."""
    scored = cut(scored)
    fit = F.col("n_features") >= 2 * min_words - 1
    none = F.lit(None).cast("long").alias("rank")
    able = scored.filter(fit)
    n = able.count()
    want = percent * n // 100
    if not want:
        return scored.select("*", none)
    low, high, above = bracket(able, want, n, width)
    order = free_name(scored.columns, "_order")
    by = [order, "id", "weight", "n_features"]
    able = able.withColumn(order, -F.col("score"))
    score = F.col("score")
    top = number_rows(able.filter(score > F.lit(high)), by, "rank")
    inside = number_rows(able.filter((score <= F.lit(high)) & (score >= F.lit(low))), by, "rank", above + 1)
    inside = inside.withColumn("rank", F.when(F.col("rank") <= want, F.col("rank")))
    rest = scored.filter(~fit | (score < F.lit(low))).select("*", none)
    return top.unionByName(inside).select(*scored.columns, "rank").unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int, seed: int, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Every row of ``docs`` as (id, n_features, weight, score, rank); ``percent`` of the long enough ones are drawn towards ``target``."""
    gain = gains(counts(docs, text_col), counts(target, text_col))
    weighed = weigh(docs, gain, id_col, text_col)
    return draw(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), percent, min_words)
