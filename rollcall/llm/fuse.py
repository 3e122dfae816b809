"""Static binary-fuse filters (8-bit, three slots), built and read in numpy.

A filter knows a fixed set of distinct 64-bit keys in about nine bits each, never denies one of them, and says yes to
another key about once in 256.
"""

from __future__ import annotations

import math

import numpy as np

from rollcall.llm.words import mix

#: Seeds tried before giving up; each fails with a chance far below one in a hundred.
TRIES = 100


def _shape(n: int) -> tuple[int, int]:
    """Length of a segment and number of segments a key can begin in."""
    if n < 2:
        return 4, 1
    length = min(1 << 18, 1 << max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    room = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)) * n
    return length, max(1, -(-int(room) // length) - 2)


def _slots(keys: np.ndarray, seed: int, length: int, begins: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    low = np.uint64(length - 1)
    s0 = ((h >> np.uint64(32)) * np.uint64(begins * length)) >> np.uint64(32)
    s1 = (s0 + np.uint64(length)) ^ ((h >> np.uint64(18)) & low)
    s2 = (s0 + np.uint64(2 * length)) ^ (h & low)
    return np.stack((s0, s1, s2)).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each is alone in), or None when keys are left over."""
    n = slots.shape[1]
    count = np.bincount(slots.ravel(), minlength=size)
    who = np.zeros(size, np.int64)
    for row in slots:
        np.bitwise_xor.at(who, row, np.arange(n))
    rounds, left = [], n
    alone = np.flatnonzero(count == 1)
    while len(alone):
        keys, pick = np.unique(who[alone], return_index=True)
        rounds.append((keys, alone[pick]))
        left -= len(keys)
        for row in slots:
            np.subtract.at(count, row[keys], 1)
            np.bitwise_xor.at(who, row[keys], keys)
        touched = np.unique(slots[:, keys])
        alone = touched[count[touched] == 1]
    return rounds if left == 0 else None


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, segments to begin in, fingerprints. Repeated keys count once."""
    keys = np.unique(np.asarray(keys).astype(np.uint64))
    length, begins = _shape(len(keys))
    size = (begins + 2) * length
    for seed in range(1, TRIES + 1):
        slots, print8 = _slots(keys, seed, length, begins)
        rounds = _peel(slots, size)
        if rounds is None:
            continue
        table = np.zeros(size, np.uint8)
        for own, slot in reversed(rounds):
            a, b, c = slots[:, own]
            table[slot] = print8[own] ^ table[a] ^ table[b] ^ table[c]
        return seed, length, begins, table.tobytes()
    raise RuntimeError(f"no filter for {len(keys)} keys in {TRIES} tries")


def might_hold(keys: np.ndarray, seed: int, length: int, begins: int, table: bytes) -> np.ndarray:
    keys = np.asarray(keys).astype(np.uint64)
    prints = np.frombuffer(table, np.uint8)
    (a, b, c), print8 = _slots(keys, seed, length, begins)
    return print8 == prints[a] ^ prints[b] ^ prints[c]
