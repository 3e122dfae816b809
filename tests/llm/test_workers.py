"""What workers keep between tasks."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa

from rollcall.llm import common, piece_viterbi


def resident() -> int:
    """MB of this process that are not mapped files."""
    with open("/proc/self/status") as f:
        return next(int(x.split()[1]) for x in f if x.startswith("RssAnon")) >> 10


def test_other_work_lets_go_of_pieces():
    model = public_tokenizers.path("piece_bpe_32k.model")
    own = piece_viterbi._pieces(model)
    assert list(common.tidy(iter, "pieces")([1])) == [1] and piece_viterbi._pieces(model) is own
    assert list(common.tidy(iter)([1, 2])) == [1, 2]
    assert piece_viterbi._pieces.cache_info().currsize == 0 and not common.HELD
    assert piece_viterbi._pieces(model) is not own


def test_freed_memory_goes_back():
    small = [pa.array([f"{k}" * 40]).to_pylist()[0].encode() for k in range(300_000)]  # fills the heap in small pieces
    keep = small[-1]
    held = resident()
    del small
    common.let_go()
    assert keep and held - resident() >= 20
