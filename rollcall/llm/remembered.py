"""Ids of the pieces of texts that a worker met lately, in Arrow buffers: a piece is asked for once, however often it comes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


def cut_at(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The pieces of ``data`` (bytes) that begin at the ascending places ``starts``, the first of which is 0."""
    ends = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


class Remembered:
    """Bounded: beyond ``most`` pieces those go first that the last texts did not have."""

    def __init__(self, most: int):
        self.most = most
        self.pieces, self.ids = pa.array([], pa.large_binary()), _lists([])

    def ids_of(self, pieces: pa.Array, learn: Callable[[list[bytes]], list[bytes]]) -> pa.Array:
        """Ids of each of ``pieces``, a list array; ``learn`` gives those of new ones as little-endian 32-bit integers."""
        known = len(self.pieces)
        coded = pa.concat_arrays([self.pieces, pieces]).dictionary_encode()  # known pieces are distinct and keep their numbers
        which = coded.indices[known:]
        every = coded.dictionary
        ids = pa.concat_arrays([self.ids, _lists(learn(every[known:].to_pylist()))])
        found = ids.take(which)
        if len(every) > self.most:
            used = np.zeros(len(every), bool)
            used[which.to_numpy()] = True
            kept = pa.array(np.concatenate((np.flatnonzero(~used), np.flatnonzero(used)))[-self.most :] if self.most else np.empty(0, np.int64))
            every, ids = every.take(kept), ids.take(kept)
        self.pieces, self.ids = every, ids
        return found


def _lists(ids: list[bytes]) -> pa.Array:
    at = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in ids], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(ids), "<u4")))
