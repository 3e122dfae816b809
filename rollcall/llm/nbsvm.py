"""Quality classifier: a linear hinge-loss model on n-gram indicators scaled by class log-count ratios.

Features of a text are indicators of its byte trigrams (case kept), words and word pairs (A-Z lower-cased), hashed to
``BUCKETS``. An indicator's value is the log-count ratio of its bucket between the classes, divided by the root of
the text's number of indicators, so that long texts stay comparable. The model is fitted by dual coordinate descent and its
margin is turned into a probability by a logistic curve fitted on rows that the descent did not see, weighted to the class
sizes among all labels.

Fitting uses at most ``SAMPLE_PER_CLASS`` labelled rows of each class, those first in the order of a hash of the id; scoring
covers whole texts of all rows and shuffles nothing.

Cases: null and empty texts have no indicators but get the score of the bias. Null labels and null ids teach nothing; a
document labelled twice counts once, with its larger label. Repeated document rows give one training row (the larger text)
and a score each. With no label at all every score is 0.5, with one class only it is that class' share after adding one
to both. Columns other than those named are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm import words
from rollcall.llm.common import free_name, slices, tidy, utf8

#: Hash buckets: the lower half for byte trigrams, the upper half for words and word pairs.
BUCKETS = 1 << 18
#: Bound of the labelled rows that a model is fitted on, for each class.
SAMPLE_PER_CLASS = 4000
ROUNDS = 15
PENALTY = 1.0
SMOOTH = 1.0


class Model(NamedTuple):
    weights: bytes  # float32 by bucket, ratio times weight
    bias: float
    slope: float
    shift: float


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """Distinct buckets of each text, in the order of the column."""
    half = BUCKETS >> 1
    place = np.zeros(BUCKETS, np.int64)
    for lo, hi in slices(column):
        data, at = utf8(column[lo:hi])
        wide = data.astype(np.uint64)
        n3 = max(0, len(data) - 2)
        tri = (wide[:n3] << np.uint64(16)) | (wide[1 : n3 + 1] << np.uint64(8)) | wide[2 : n3 + 2]
        tri = (words.mix(tri) % np.uint64(half)).astype(np.int64)
        one, first = words.words(data, at)
        two = words.mix(one[:-1] * np.uint64(3) + one[1:] * np.uint64(5)) if len(one) else one
        one = (one % np.uint64(half)).astype(np.int64) + half
        two = (two % np.uint64(half)).astype(np.int64) + half
        for i in range(hi - lo):
            own = np.concatenate(
                (
                    tri[at[i] : max(at[i], at[i + 1] - 2)],
                    one[first[i] : first[i + 1]],
                    two[first[i] : max(first[i], first[i + 1] - 1)],
                )
            )
            count = np.arange(len(own))
            place[own] = count
            yield own[place[own] == count]


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by bucket and bias of the L1-loss machine; ``cost`` bounds each row's dual variable."""
    w, bias = np.zeros(len(ratio)), 0.0
    x = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    square = np.array([v @ v + 1.0 for v in x])
    dual = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * (w[rows[i]] @ x[i] + bias) - 1.0
            to = min(max(dual[i] - slope / square[i], 0.0), cost[i])
            if (step := (to - dual[i]) * y[i]) != 0.0:
                w[rows[i]] += step * x[i]
                bias += step
                dual[i] = to
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def _curve(margin: np.ndarray, up: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of least weighted log loss with softened targets, by Newton's method."""
    ups, downs = (weight * up).sum(), (weight * ~up).sum()
    aim = np.where(up, (ups + 1) / (ups + 2), 1 / (downs + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = weight * (p - aim), weight * p * (1 - p)
        grad = np.array([(g * margin).sum() + 1e-3 * (a - 1), g.sum()])
        hess = np.array([[(h * margin**2).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit_rows(rows: list[np.ndarray], label: np.ndarray, of_class: tuple[int, int]) -> Model:
    """Model of the given rows; ``of_class``: number of all labels 0 and 1."""
    up = label == 1
    if not up.any() or up.all():
        share = (of_class[1] + 1) / (sum(of_class) + 2)
        return Model(np.zeros(BUCKETS, np.float32).tobytes(), 0.0, 1.0, float(np.log(share / (1 - share))))
    counts = [np.full(BUCKETS, SMOOTH), np.full(BUCKETS, SMOOTH)]
    apart = np.arange(len(rows)) % 5 == 4
    if not (up[apart].any() and not up[apart].all() and up[~apart].any() and not up[~apart].all()):
        apart[:] = False
    learn = np.flatnonzero(~apart)
    for i in learn:
        counts[int(up[i])][rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    share = np.where(up, 1 / up[learn].sum(), 1 / (~up[learn]).sum()) * len(learn) / 2
    w, bias = descend([rows[i] for i in learn], np.where(up, 1.0, -1.0)[learn], ratio, PENALTY * share[learn])
    scaled = (w * ratio).astype(np.float32)
    see = np.flatnonzero(apart) if apart.any() else learn
    margin = np.array([scaled[rows[i]].sum() / np.sqrt(max(1, len(rows[i]))) + bias for i in see])
    weight = np.where(up[see], of_class[1] / up.sum(), of_class[0] / (~up).sum())
    return Model(scaled.tobytes(), float(bias), *map(float, _curve(margin, up[see], weight)))


def sample(labels: DataFrame, id_col: str, label_col: str, per_class: int) -> DataFrame:
    """Ids and labels to learn from, ``per_class`` of each class at most."""
    clean = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).alias("_label"))
    )
    order = (F.xxhash64("_id"), F.col("_id"))
    return clean.filter("_label = 0").orderBy(*order).limit(per_class).union(
        clean.filter("_label = 1").orderBy(*order).limit(per_class)
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = SAMPLE_PER_CLASS,
) -> Model:
    """Model of ``label_col``, fitted in one task on the bounded sample of ``labels``."""
    sizes = {r[0]: r[1] for r in labels.filter(F.col(id_col).isNotNull()).groupBy(label_col).agg(F.count_distinct(id_col)).collect()}
    of_class = (sizes.get(0, 0), sizes.get(1, 0))
    chosen = F.broadcast(sample(labels, id_col, label_col, per_class))
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
        .join(chosen, "_id")
        .groupBy("_id", "_label")
        .agg(F.max("_text").alias("_text"))
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [x.astype(np.int32).tobytes() for x in indicators(b.column("_text"))]
            yield pa.record_batch([b.column("_id"), b.column("_label").cast(pa.int32()), pa.array(found, pa.binary())], ["_id", "_label", "_found"])

    kind = dict(rows.dtypes)["_id"]

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_id", kind="stable")
        found = [np.frombuffer(x, np.int32) for x in pdf["_found"]]
        return pd.DataFrame([fit_rows(found, pdf["_label"].to_numpy(), of_class)])

    fitted = (
        rows.mapInArrow(tidy(extract), f"_id {kind}, _label int, _found binary")
        .withColumn("_all", F.lit(0))
        .groupBy("_all")
        .applyInPandas(train, "weights binary, bias double, slope double, shift double")
        .first()
    )
    if fitted is None:
        return fit_rows([], np.empty(0), of_class)
    return Model(bytes(fitted["weights"]), fitted["bias"], fitted["slope"], fitted["shift"])


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in a further column (a longer name if it is taken)."""
    name = free_name(docs.columns, name)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        w = np.frombuffer(m.weights, np.float32)
        for b in batches:
            for lo, hi in slices(b.column(place)):
                part = b.slice(lo, hi - lo)
                margin = np.array([w[x].sum() / np.sqrt(max(1, len(x))) + m.bias for x in indicators(part.column(place))])
                p = 1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -30, 30)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], [*part.schema.names, name])

    # whole rows pass in slices of about a megabyte; nothing waits for a column to come back
    return docs.mapInArrow(tidy(ask), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def fold(id_col: Column, folds: int) -> Column:
    """Fold of a row by its id; a null id is in fold 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds, F.lit(0))
