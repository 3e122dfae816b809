"""Word and shingle hashes of whole Arrow text columns, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. A word's hash is a polynomial in its bytes, read off a
running sum, so no text is cut into Python strings. A shingle of ``n`` words is one 64-bit hash; a text of fewer words
(one at least) has one shingle of all its words; an empty text has none.
"""

from __future__ import annotations

import numpy as np

from rollcall.llm.common import SLICE_BYTES

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > 4 * SLICE_BYTES:  # one word of megabytes: not kept
            return have[:n]
        _powers[base] = have
    return have[:n]


def _stretches(space: np.ndarray, at: np.ndarray):
    """Cuts the buffer between words into stretches of about a slice."""
    lo, n = 0, len(space)
    while lo < n:
        hi = min(n, lo + SLICE_BYTES)
        if hi < n:
            text = int(at[np.searchsorted(at, hi, "right") - 1])
            gaps = np.flatnonzero(space[lo + 1 : hi])
            gap = lo + 1 + int(gaps[-1]) if len(gaps) else 0
            best = max(text, gap)
            if best <= lo:
                after = np.flatnonzero(space[hi:])
                gap = hi + int(after[0]) if len(after) else n
                best = min(gap, int(at[np.searchsorted(at, hi, "left")]))
            hi = best
        yield lo, hi
        lo = hi


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and per text the number of the first word (one more at the end)."""
    space = _SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[at] = True
    hashes, firsts = [], []
    for lo, hi in _stretches(space, at):
        ink = ~space[lo:hi]
        new = head[lo:hi].copy()
        new[0] = True
        new[1:] |= space[lo : hi - 1]
        begin = np.flatnonzero(ink & new)
        last = np.ones(hi - lo, bool)
        last[:-1] = space[lo + 1 : hi] | head[lo + 1 : hi]
        end = np.flatnonzero(ink & last) + 1
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_LOWER[data[lo:hi]] * _power(_BASE, hi - lo), out=total[1:])
        hashes.append(mix((total[end] - total[begin]) * _power(_INVERSE, hi - lo)[begin]))
        firsts.append(begin + lo)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    first = np.concatenate(firsts)
    return np.concatenate(hashes), np.searchsorted(first, at, "left").astype(np.int64)


def _weights(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in reading order, and per text the number of its first."""
    count = np.diff(first)
    own = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    start = np.concatenate(([0], np.cumsum(own)))
    out = np.zeros(int(start[-1]), np.uint64)
    if not len(out):
        return out, start
    text = np.repeat(np.arange(len(own)), own)
    place = first[text] + (np.arange(len(out)) - start[text])
    width = np.minimum(count, n)[text]
    weights = _weights(n)
    for j in range(n):
        inside = width > j
        if inside.all():
            out += hashes[place + j] * weights[j]
        else:
            out[inside] += hashes[place[inside] + j] * weights[j]
    return mix(out + width.astype(np.uint64)), start
