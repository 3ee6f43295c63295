"""Quality classifier: naive Bayes support vectors.

A document is the set of its hashed n-grams: byte n-grams of one to three bytes, word n-grams of
one and two words, and n-grams of up to three marks that say whether a word repeats one of the
four before it. Indicators are scaled by the class log-count ratio of their n-gram, vectors are
brought to length one, and a linear hinge-loss model is fitted by dual coordinate descent. A
logistic curve over the margins, fitted on margins of held-out halves, turns them into scores.

Labels come from a bounded sample (``TRAIN_ROWS``) of the labelled training rows, so the fit
costs the same at every size; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .frames import pick
from .toxicity import fit_logistic, training_rows

TRAIN_ROWS = 6000  # labelled rows that a fit uses at most, by hash of doc_id
BITS = 16
ALPHA = 1.0  # added to each class's count of an n-gram
PENALTY = 1.0  # upper bound of a dual variable
EPOCHS = 15
U64 = np.uint64
_TOP = U64(64 - BITS)


def gram_sets(buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """Per text, which of the 2**BITS hashed n-grams it has."""
    b = buf.astype(U64)
    one = (tk.mix(np.arange(256, dtype=U64) + U64(11)) >> _TOP).astype(np.uint16)
    two = (tk.mix(((b[:-1] << U64(8)) | b[1:]) + U64(1 << 20)) >> _TOP).astype(np.uint16) if len(b) > 1 else b[:0].astype(np.uint16)
    three = (tk.mix(((b[:-2] << U64(16)) | (b[1:-1] << U64(8)) | b[2:]) + U64(1 << 30)) >> _TOP).astype(np.uint16) if len(b) > 2 else two[:0]
    w, at = tk.word_hashes(buf, offs)
    again = np.zeros(len(w), U64)
    for d in range(1, 5):
        again[d:] |= (w[d:] == w[:-d]).astype(U64)
    for i in range(len(offs) - 1):
        mask = np.zeros(1 << BITS, bool)
        a, z = offs[i], offs[i + 1]
        mask[one[buf[a:z]]] = True
        mask[two[a:max(a, z - 1)]] = True
        mask[three[a:max(a, z - 2)]] = True
        x, r = w[at[i]:at[i + 1]], again[at[i]:at[i + 1]].copy()
        r[:4] = [len(set(x[max(0, j - 4):j + 1])) < min(j, 4) + 1 for j in range(min(4, len(x)))]
        mask[tk.mix(x + U64(3)) >> _TOP] = True
        mask[tk.mix(x[:-1] * U64(5) + x[1:] + U64(7)) >> _TOP] = True
        for n in (1, 2, 3):
            if len(r) >= n:
                code = sum(r[j:len(r) - n + 1 + j] << U64(j) for j in range(n)) | U64(1 << (8 + n))
                mask[tk.mix(np.unique(code) + U64(1 << 40)) >> _TOP] = True
        yield mask


class Model:
    """Scaled weights per n-gram, squared scales (for the length of a vector), bias and curve."""

    def __init__(self, weight: np.ndarray, square: np.ndarray, bias: float, curve: tuple[float, float]):
        self.weight, self.square, self.bias, self.curve = weight, square, bias, curve

    def margin(self, mask: np.ndarray) -> float:
        on = np.flatnonzero(mask)
        length = float(np.sqrt(self.square[on].sum()))
        return float(self.weight[on].sum()) / length + self.bias if length > 0 else self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        m = np.array([self.margin(g) for _, buf, offs in tk.chunks(column, 1 << 20) for g in gram_sets(buf, offs)])
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * m + self.curve[1], -30, 30)))


def descend(rows: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights times scales, squared scales, bias) by dual coordinate descent; rows: n-grams on."""
    dim = 1 << BITS
    count = {s: np.full(dim, ALPHA) for s in (1, -1)}
    for r, s in zip(rows, y):
        count[int(s)][r] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[-1] / count[-1].sum())
    x = []
    for r in rows:
        v = ratio[r]
        norm = np.sqrt((v * v).sum())
        x.append(v / norm if norm > 0 else v)
    w, bias = np.zeros(dim), 0.0
    a = np.zeros(len(rows))
    q = np.array([(v * v).sum() + 1 for v in x])
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], x[i]
            g = y[i] * (w[r] @ v + bias) - 1
            new = min(max(a[i] - g / q[i], 0.0), PENALTY)
            if new != a[i]:
                d = (new - a[i]) * y[i]
                w[r] += d * v
                bias += d
                moved = max(moved, abs(new - a[i]))
                a[i] = new
        if moved < 1e-3:
            break
    return w * ratio, ratio * ratio, bias


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from labelled rows whose crc32(doc_id as text) mod 3 is not 1.

    With a single class among them every score is on that class's side; with none it is 0.5.
    """
    sample = training_rows(labels, docs, "quality", 3, 1, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            on = [np.flatnonzero(g).astype(np.uint16).tobytes() for _, buf, offs in tk.chunks(b.column(3), 1 << 20) for g in gram_sets(buf, offs)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2).cast(pa.int64()), pa.array(on, pa.binary())],
                                             ["doc_id", "y", "half", "grams"])

    got = sorted(sample.select("doc_id", "y", "half", "text").mapInArrow(run, "doc_id long, y int, half long, grams binary")
                 .collect(), key=lambda r: (r.doc_id, bytes(r.grams)))  # at most ``rows``
    grams = [np.frombuffer(r.grams, np.uint16) for r in got]
    y = np.array([1.0 if r.y else -1.0 for r in got])
    dim = 1 << BITS
    if len(set(y)) < 2:
        return Model(np.zeros(dim), np.zeros(dim), float(y[0]) if len(y) else 0.0, (2.0, 0.0))
    half = np.array([r.half for r in got])
    margin = np.zeros(len(got))
    for h in (0, 1):
        other = np.flatnonzero(half != h)
        if len(set(y[other])) == 2:
            m = Model(*descend([grams[i] for i in other], y[other]), (1, 0))
            for i in np.flatnonzero(half == h):
                mask = np.zeros(dim, bool)
                mask[grams[i]] = True
                margin[i] = m.margin(mask)
    curve = fit_logistic(margin[:, None], (y > 0).astype(float), ridge=1e-3)
    return Model(*descend(grams, y), (max(float(curve[0]), 1e-3), float(curve[1])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of (doc_id, text).

    Null texts count as empty; a text without n-grams gets the model's bias. A null doc_id is not
    held out. Repeated rows repeat; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.scores(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])
    return (pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
            .select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
                    "score", "predicted"))
