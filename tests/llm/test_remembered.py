"""What a worker remembers of the pieces of texts, and that it changes no id."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers

from rollcall.llm import bitplanes
from rollcall.llm.remembered import Remembered, cut_at

BPE = public_tokenizers.path("word_bpe_49k.json")


def odd_texts() -> list[str]:
    draw = random.Random(4)
    signs = "abcdeitnrsABÉéßöñ²·0123456789.,;:!?$#&*()<>|/\\'\"-_ \t\n\r▁日本語ลักษเ́🎉\x00\x85\xa0"
    plain = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 12))) + draw.choice(["", ",", ".", "***", "\n", " \n\n"]) for _ in range(400)]
    return ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(1500)] + [" ".join(draw.choices(plain, k=30)) for _ in range(100)] + ["", " ", "\n", " \n ", "a" * 300]


def test_pieces_are_learnt_once_and_bounded():
    asked: list[bytes] = []

    def learn(new):
        asked.extend(new)
        return [np.frombuffer(p, np.uint8).astype("<u4").tobytes() for p in new]

    held = Remembered(3)
    for text, news in ((b"aabbaacc", [b"aa", b"bb", b"cc"]), (b"ccddcc", [b"dd"]), (b"ccdd", []), (b"aabbccddeeff", None), (b"", [])):
        asked.clear()
        pieces = cut_at(np.frombuffer(text, np.uint8), np.arange(0, len(text), 2))
        ids = held.ids_of(pieces, learn)
        assert [bytes(x) for x in ids.to_pylist()] == [text[k : k + 2] for k in range(0, len(text), 2)]
        assert len(held.pieces) == len(held.ids) <= 3 and (news is None or asked == news)


def test_gap_behind_a_piece_does_not_count(monkeypatch):
    encoder = bitplanes.Encoder(BPE)
    encoder.encode(["zugefroren zugefroren\n"])
    asked = []
    monkeypatch.setattr(encoder, "_ask", lambda pieces, ask=encoder._ask: asked.extend(pieces) or ask(pieces))
    encoder.encode(["zugefroren\t\tzugefroren  zugefroren\r\n"])
    assert asked == [] and len(encoder.pieces.pieces) == 1


def test_ids_of_odd_texts(monkeypatch):
    texts = odd_texts()
    monkeypatch.setattr(bitplanes, "REMEMBERED", 50)
    encoder, whole = bitplanes.Encoder(BPE), bitplanes.Encoder(BPE, split=False)
    for lo in range(0, len(texts), 100):
        assert encoder.encode(texts[lo : lo + 100]) == whole.encode(texts[lo : lo + 100])
