"""Words of a text are cut where no piece passes, and encoded once."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import sentencepiece

from rollcall.llm import piece_viterbi
from tests.llm.test_remembered import odd_texts

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_word_and_sign_behind_it_are_learnt_apart(monkeypatch):
    seen = []
    monkeypatch.setattr(piece_viterbi.Merges, "_path", lambda self, text, run=piece_viterbi.Merges._path: seen.append(text) or run(self, text))
    piece_viterbi.Merges(PIECES).encode("so schscheinkeit, schscheinkeit. schscheinkeit***")
    assert seen.count("▁schscheinkeit") == 1 and "▁schscheinkeit," not in seen


def test_ids_of_odd_texts(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts()
    monkeypatch.setattr(piece_viterbi, "REMEMBERED", 50)
    pieces = piece_viterbi.Merges(PIECES)
    for lo in range(0, len(texts), 100):
        own = pa.array(texts[lo : lo + 100], pa.string())
        ids, at = pieces.encode_column(own)
        for text, x, y in zip(texts[lo : lo + 100], at[:-1], at[1:], strict=True):
            if "▁" not in text:
                assert ids[x:y].tolist() == library.encode(text), repr(text)
            assert pieces.decode(ids[x:y].tolist()) == text.encode()
        assert all(pieces.same(ids, at, own))
    broken, k = ids.copy(), int(at[-2])
    broken[k] = broken[k] + 1
    assert pieces.same(broken, at, own)[-1] is False
    plain = pa.array(["ab", None, ""], pa.string())
    assert pieces.encode_column(plain)[1].tolist()[1:] == [len(library.encode("ab"))] * 3
