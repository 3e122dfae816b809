"""SentencePiece encoding over an Aho-Corasick automaton of the pieces, and decoding.

The automaton reads a text once and reports every piece that ends at each position, following its output links. What is made
of these matches depends on the kind of model.

* *Unigram* (``Pieces``): scores are log probabilities. A single-pass Viterbi: each match relaxes the best score of its end:
  best score where the piece begins plus the piece's score. A character that is no piece by itself may be passed at
  ``UNKNOWN`` below the lowest score. The ids are read back from the end. Equal sums go to the longer last piece.
* *BPE* (``Merges``): scores are ranks of merges, whose sum means nothing. The merges are replayed: of all neighbours
  that make up a match together, those of the best score (of equal ones the leftmost) become one, until none are left. These
  are the ids of ``SentencePieceProcessor.encode``.

In both, a character that is in no piece is written as its UTF-8 bytes (byte pieces).

A space is written ``\\u2581`` and the text gets one in front, as the model files ask for. If in no piece that sign
follows another character (checked against the file), no piece passes between a word and the space after it, so a
text is encoded word by word and words met before are remembered (``Remembered``); the result is that of the whole text. Line feeds divide in the
same way if no piece holds one, and for a BPE model any two characters that no piece holds side by side. The sign itself in a source text is written as bytes, so decoding gives back every text; this
alone differs from the library, which takes it for a space.

Cases: null and empty texts have no ids. Repeated rows are encoded each. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from rollcall.llm.common import HELD, slices, tidy, utf8
from rollcall.llm.remembered import Remembered, cut_at

SPACE = "▁"
UNKNOWN = 10.0
#: Half of the words whose ids a worker remembers.
REMEMBERED = 200_000
#: Bytes of text that are encoded at once.
SLICE = 2 << 20
#: Characters of a text up to which its merges are found without a heap.
SHORT = 64
#: Stands for no match: size, score, id.
_NONE = (0, float("-inf"), -1)


class Pieces:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        self.byte_id: dict[int, int] = {}
        self.bytes_of: list[bytes] = []
        scores = []
        self.safe, self.lines, self.single = True, True, set()
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                self.automaton.add_word(piece, (len(piece), model.get_score(i), i))
                scores.append(model.get_score(i))
                self.safe &= SPACE not in piece.lstrip(SPACE)
                self.lines &= "\n" not in piece
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()
        self.lowest = min(scores) - UNKNOWN
        self.words = Remembered(2 * REMEMBERED if self.safe else 0)
        self.table = pa.array(self.bytes_of, pa.large_binary())
        self.parted = np.zeros(1 << 16, bool)

    def best_path(self, text: str) -> list[int]:
        """Ids of ``text`` (spaces as they are, nothing put in front)."""
        first, *others = text.split(SPACE)
        out = self._path(first.replace(" ", SPACE))
        here = [self.byte_id[b] for b in SPACE.encode()] if others else []
        for part in others:
            out += here
            out += self._path(part.replace(" ", SPACE))
        return out

    def _path(self, text: str) -> list[int]:
        n = len(text)
        best, back = [0.0] * (n + 1), [(0, -1)] * (n + 1)
        reached = 0
        for end, (size, score, i) in self.automaton.iter(text):
            end += 1
            while reached < end:  # the character may be unknown
                reached += 1
                best[reached], back[reached] = float("-inf"), (reached - 1, -1)
                if text[reached - 1] not in self.single:
                    best[reached] = best[reached - 1] + self.lowest
            if (total := best[end - size] + score) > best[end]:
                best[end], back[end] = total, (end - size, i)
        while reached < n:
            reached += 1
            back[reached] = (reached - 1, -1)
        out, at = [], n
        while at:
            begin, i = back[at]
            if i >= 0:
                out.append(i)
            else:
                out += [self.byte_id[b] for b in reversed(text[begin:at].encode())]
            at = begin
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian int32."""
        return self.encode_column(pa.array([text], pa.large_string()))[0].tobytes()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (int32) of all texts one after the other, and where each text's begin (one place more at the end).

        Each text but an empty one gets a space in front. A word begins at the first of some spaces, at a line feed and after one.
        """
        data, at = utf8(texts)
        full = at[:-1] < at[1:]
        data = np.insert(data, at[:-1][full], ord(" "))
        at = at + np.concatenate(([0], np.cumsum(full)))
        starts = np.zeros(len(data) + 1, bool)
        if self.safe:
            gap = data == ord(" ")
            starts[1:-1] = gap[1:] & ~gap[:-1]
            if self.lines:
                feed = data == ord("\n")
                starts[:-1] |= feed
                starts[1:] |= feed
        starts[1:-1] |= self.parted[data[:-1].astype(np.uint16) << 8 | data[1:]]
        starts[at] = True
        first = np.flatnonzero(starts[:-1])
        ids = self.words.ids_of(cut_at(data, first), self._learn)
        return ids.flatten().to_numpy().view(np.int32), ids.offsets.to_numpy()[np.searchsorted(first, at, "left")]

    def _learn(self, words: list[bytes]) -> list[bytes]:
        return [np.array(self.best_path(w.decode()), "<i4").tobytes() for w in words]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:]

    def same(self, ids: np.ndarray, at: np.ndarray, texts: pa.Array) -> list[bool]:
        """Whether the ids of each text (from its place in ``at``) decode to it."""
        back, ends = utf8(self.table.take(pa.array(ids)))
        data, begin = utf8(texts)
        back, data, ends = memoryview(back), memoryview(data), ends[at].tolist()
        return [back[x:y][1:] == data[v:w] for (x, y), (v, w) in zip(pairwise(ends), pairwise(begin.tolist()), strict=True)]


class Merges(Pieces):
    """The same for a BPE model. A word is also cut between any two characters that no piece holds side by side."""

    def __init__(self, path: str):
        super().__init__(path)
        #: By two neighbouring bytes: whether a character begins between them and no piece holds them so.
        self.parted = np.repeat([(k & 0xC0) != 0x80 for k in range(256)], 256).reshape(256, 256).T.ravel()
        for piece in self.automaton:
            raw = np.frombuffer(piece.replace(SPACE, " ").encode(), np.uint8)
            self.parted[raw[:-1].astype(np.uint16) << 8 | raw[1:]] = False

    def _path(self, text: str) -> list[int]:
        # a stretch of the text is named by the places of the character before it and of its last one
        n = len(text)
        found = {(last - match[0]) * n + last: match for last, match in self.automaton.iter(text)}
        cuts = self._by_list(n, found.get) if n <= SHORT else self._by_heap(n, found.get)
        out = []
        for a, last in pairwise(cuts):
            match = found.get(a * n + last)
            if match:
                out.append(match[2])
            else:
                out += [self.byte_id[b] for b in text[last].encode()]
        return out

    @staticmethod
    def _by_list(n: int, match: Callable[[int, tuple], tuple]) -> list[int]:
        """Where the pieces end, -1 in front; looks through all neighbours for each merge."""
        cuts = list(range(-1, n))
        score = [match(k * n + k + 2, _NONE)[1] for k in range(-1, n - 2)]
        while score and (best := max(score)) > _NONE[1]:
            k = score.index(best)
            del cuts[k + 1], score[k]
            if k:
                score[k - 1] = match(cuts[k - 1] * n + cuts[k + 1], _NONE)[1]
            if k < len(score):
                score[k] = match(cuts[k] * n + cuts[k + 2], _NONE)[1]
        return cuts

    @staticmethod
    def _by_heap(n: int, match: Callable[[int, tuple], tuple]) -> list[int]:
        """The same for long texts."""
        after, before = [*range(1, n + 1), n], list(range(-1, n))  # cuts by number (place + 1); after is 0 for one taken away
        todo = [(-match(k * n + k + 2, _NONE)[1], k + 1, k + 2, k + 3) for k in range(-1, n - 2)]
        heapify(todo)
        while todo:
            worse, a, middle, b = heappop(todo)
            if worse == -_NONE[1]:
                break
            if after[a] != middle or after[middle] != b:  # one of them was merged meanwhile
                continue
            after[a], after[middle], before[b] = b, 0, a
            if a:
                heappush(todo, (-match((before[a] - 1) * n + b - 1, _NONE)[1], before[a], a, b))
            if b < n:
                heappush(todo, (-match((a - 1) * n + after[b] - 1, _NONE)[1], a, b, after[b]))
        cuts, at = [-1], 0
        while at < n:
            at = after[at]
            cuts.append(at - 1)
        return cuts


@lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    HELD["pieces"] = _pieces.cache_clear
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
    if model.trainer_spec.model_type != model.trainer_spec.BPE:
        return Pieces(path)
    kind = sentencepiece_model_pb2.ModelProto.SentencePiece
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
        raise ValueError("user-defined and unused pieces of a BPE model are not covered")
    return Merges(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_pieces``, ``ids`` and ``round_trip``: whether decoding the ids gives the text again."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for b in batches:
            texts = b.column("text")
            for lo, hi in slices(texts, SLICE):
                found, at = pieces.encode_column(texts[lo:hi])
                same = pieces.same(found, at, texts[lo:hi])
                ids = pa.ListArray.from_arrays(pa.array(at), pa.array(found))
                yield pa.record_batch(
                    [b.column("id")[lo:hi], pa.array(np.diff(at).astype(np.int64)), ids, pa.array(same, pa.bool_())],
                    ["id", "n_pieces", "ids", "round_trip"],
                )

    found = rows.mapInArrow(tidy(run, "pieces"), f"id {kind}, n_pieces long, ids array<int>, round_trip boolean")
    return found.select(F.col("id").alias(id_col), "n_pieces", "ids", "round_trip")


def decode(rows: DataFrame, model: str, ids_col: str = "ids", name: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids_col`` in column ``name``; null ids give an empty text."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _pieces(model)
        for s in batches:
            yield pd.Series([pieces.decode(x.tolist()).decode() if x is not None else "" for x in s])

    return rows.withColumn(name, run(ids_col))
