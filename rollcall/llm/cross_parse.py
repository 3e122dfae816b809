"""Language by cross-parsing: the language whose labelled text needs fewest phrases to spell a text wins.

For every language a suffix automaton of a bounded sample of labelled text is built. A text is parsed greedily against it:
each phrase is the longest match that the automaton can spell from where the last phrase ended (one symbol at least). Phrases
per symbol estimate the cross entropy between the text and the language. Texts are reduced to symbols first: letters
in lower case, any run of other characters as one gap. They are parsed in blocks of ``BLOCK`` symbols, each beginning a
phrase, so that thousands of blocks walk the automaton in step and one long text is many blocks.

The sample per language: whole texts of at most ``SAMPLE_SYMBOLS / 8`` characters, first in the order of a hash of the id, of
``SAMPLE_TEXTS`` candidates, while they fit in ``SAMPLE_SYMBOLS`` characters; if no text is that short, the head of the first.

Cases: a null text or one without a letter is ``und`` with score 0. With ties the language first in text order wins.
Without any labelled text all rows are ``und``. Null ids and null languages teach nothing; repeated rows teach once and are
predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, slices

#: Bound of the labelled text per language, in characters, and of the texts it is picked from.
SAMPLE_SYMBOLS = 50_000
SAMPLE_TEXTS = 64
BLOCK = 512
UNKNOWN = "und"
_SLICE = 4 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter of the basic plane, 0 for all else."""
    out = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def reduced(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case (code points) and gaps (0) of all texts, and where each text begins."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    wide = points >= 1 << 16
    out = _letters()[np.where(wide, 0, points)]
    if wide.any():
        far = points[wide]
        kinds, which = np.unique(far, return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in kinds])
        out[wide] = np.where(letter[which], far, 0)
    stay = np.ones(len(out), bool)
    stay[1:] = (out[1:] != 0) | (out[:-1] != 0)
    starts = at[:-1][at[:-1] < len(out)]
    stay[starts] = True
    return out[stay], np.concatenate(([0], np.cumsum(stay)))[at]


def automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """Transitions (state, symbol) of the suffix automaton; 0, the start, stands for none."""
    nexts: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for c in symbols.tolist():
        own = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = own
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[own] = q
            else:
                twin = len(nexts)
                nexts.append(nexts[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = twin
                    p = link[p]
                link[q] = link[own] = twin
        last = own
    table = np.zeros((len(nexts), width), np.int32)
    for state, row in enumerate(nexts):
        if row:
            table[state, list(row)] = list(row.values())
    return table


class Parser:
    """Automata of all languages over one alphabet."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        known = {k: reduced([texts[k]])[0] for k in self.languages}
        self.alphabet = np.unique(np.concatenate([[0], *known.values()]).astype(np.uint32))
        self.width = len(self.alphabet) + 1  # the last stands for letters that no language knows
        self.tables = [automaton(self._index(known[k]), self.width).ravel() for k in self.languages]

    def _index(self, points: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.alphabet, points)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == points, at, len(self.alphabet)).astype(np.int32)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases by text and language, symbols by text, and whether a text has a letter."""
        points, at = reduced(texts)
        count = np.diff(at)
        lanes = -(-count // BLOCK)
        begin = np.concatenate(([0], np.cumsum(lanes)))
        has_letter = np.add.reduceat(np.append(points != 0, False).astype(np.int64), np.minimum(at[:-1], len(points))) > 0 if len(texts) else np.zeros(0, bool)
        has_letter &= count > 0
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        if not begin[-1]:
            return out, count, has_letter
        text = np.repeat(np.arange(len(texts)), count)
        inside = np.arange(len(points)) - at[text]
        lane = begin[text] + inside // BLOCK
        size = np.bincount(lane, minlength=begin[-1])
        order = np.argsort(-size, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        grid = np.zeros((BLOCK, len(order)), np.int32)
        grid[inside % BLOCK, rank[lane]] = self._index(points)
        alive = np.searchsorted(-size[order], -np.arange(BLOCK), "left")
        owner = np.repeat(np.arange(len(texts)), lanes)[order]
        for k, table in enumerate(self.tables):
            state = np.zeros(len(order), np.int32)
            begun = np.zeros(len(order), np.int64)
            for step in range(BLOCK):
                n = alive[step]
                if not n:
                    break
                symbol, now = grid[step, :n], state[:n]
                to = table[now * self.width + symbol]
                fresh = (to == 0) | (now == 0)
                begun[:n] += fresh
                lost = np.flatnonzero(to == 0)
                to[lost] = table[symbol[lost]]
                state[:n] = to
            out[:, k] = np.bincount(owner, weights=begun, minlength=len(texts))
        return out, count, has_letter

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        found, _, has_letter = self.phrases(texts)
        best = found.argmin(axis=1)
        more = (found - found.min(axis=1, keepdims=True)).astype(float)
        score = 1 / np.exp(-np.minimum(more, 700)).sum(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)]
        return names, np.where(has_letter, score, 0.0)


@lru_cache(maxsize=2)
def _parser(texts: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(texts))


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Sample text by language of the rows given."""
    short = SAMPLE_SYMBOLS // 8
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    fits = (F.length("text") > short).cast("int")
    rows = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    # one row of each id, language and text: copies of an id take one place, whatever their number
    picked = (
        rows.groupBy("lang", "id", "digest")
        .agg(F.min(fits).alias("fits"))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("fits", F.xxhash64("id"), "id", "digest")))
        .filter(F.col("place") <= SAMPLE_TEXTS)
        .select("id", "lang", "digest", "place")
    )
    heads = (
        rows.join(F.broadcast(picked), ["id", "lang", "digest"])
        .select("lang", "place", F.substring("text", 1, SAMPLE_SYMBOLS).alias("text"))
        .distinct()
        .collect()
    )
    out: dict[str, str] = {}
    for lang, _, text in sorted(heads):
        have = out.get(lang, "")
        if not have or len(text) <= short and len(have) + len(text) < SAMPLE_SYMBOLS:
            out[lang] = f"{have}\n{text}"
    return out


def predict(docs: DataFrame, sample: dict[str, str], text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct (lang, score) in a further column (a longer name if it is taken)."""
    name = free_name(docs.columns, name)
    if not sample:
        return docs.withColumn(name, F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score")))
    held = docs.sparkSession.sparkContext.broadcast(tuple(sorted(sample.items())))

    @F.pandas_udf("lang string, score double")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(held.value)
        for s in batches:
            texts = pa.array(s, pa.large_string(), from_pandas=True)
            names, scores = [], []
            for lo, hi in slices(texts, _SLICE):
                n, p = parser.predict(s.iloc[lo:hi].tolist())
                names += n
                scores.append(p)
            yield pd.DataFrame({"lang": names, "score": np.concatenate(scores) if scores else np.empty(0)})

    return docs.withColumn(name, ask(F.coalesce(F.col(text_col), F.lit(""))))
