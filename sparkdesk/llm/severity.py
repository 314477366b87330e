"""Toxicity severity by cumulative-link ordinal regression.

P(grade <= k) = 1 / (1 + exp(w.x - t_k)): one weight vector is shared by all thresholds
t_0 < t_1 < ...  The features are log counts of hashed words; an absolute-value penalty keeps
the weights sparse, so that words of single documents get none.  The model is fitted on a
bounded sample of labelled rows and scores every document.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import documents, text_key

#: ASCII characters that are not letters or digits separate words.
_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature numbers and values of a whole text."""
    counts = Counter(text.encode().lower().translate(_SPACES).split())
    if not counts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    index = np.fromiter((zlib.crc32(w) & (1 << bits) - 1 for w in counts), np.int64, len(counts))
    where, inverse = np.unique(index, return_inverse=True)
    values = np.log1p(np.bincount(inverse, np.fromiter(counts.values(), np.float64, len(counts))))
    return where.astype(np.int32), values.astype(np.float32)


class Model:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """One row of grade probabilities for each score w.x."""
        upto = 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -50, 50)))
        upto = np.hstack([np.zeros((len(scores), 1)), upto, np.ones((len(scores), 1))])
        return np.diff(upto, axis=1)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, n_grades: int, *, rounds: int = 300,
        rate: float = 0.5, l1: float = 3e-4) -> Model:
    """Penalised maximum likelihood by full-batch gradient steps with per-weight scaling
    (AdaGrad), each followed by a step of all weights towards zero."""
    size = 1 << bits
    thresholds = np.arange(n_grades - 1, dtype=float) + 1.0
    if not rows:
        return Model(np.zeros(size, np.float32), thresholds)
    cols = np.concatenate([r[0] for r in rows])
    vals = np.concatenate([r[1] for r in rows]).astype(float)
    at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    y = np.array([r[2] for r in rows])
    w, gw, gt = np.zeros(size), np.full(size, 1e-8), np.full(n_grades - 1, 1e-8)
    padded = lambda t: np.concatenate([[-np.inf], t, [np.inf]])
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    for _ in range(rounds):
        score = np.bincount(at, vals * w[cols], len(rows))
        high, low = sigmoid(padded(thresholds)[y + 1] - score), sigmoid(padded(thresholds)[y] - score)
        high[y == n_grades - 1], low[y == 0] = 1.0, 0.0
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        step = np.bincount(cols, vals * (d_high - d_low)[at], size) / len(rows)
        step_t = np.array([d_low[y == k + 1].sum() - d_high[y == k].sum() for k in range(n_grades - 1)]) / len(rows)
        gw, gt = gw + step * step, gt + step_t * step_t
        pace = rate / np.sqrt(gw)
        w -= pace * step
        w = np.sign(w) * np.maximum(np.abs(w) - pace * l1, 0.0)
        thresholds = np.maximum.accumulate(thresholds - rate * step_t / np.sqrt(gt) + np.arange(n_grades - 1) * 1e-9)
    return Model(w.astype(np.float32), thresholds)


def labelled_sample(docs: DataFrame, labels: DataFrame, *, rows: int, bits: int, n_grades: int) -> list:
    """(features, values, grade) of at most ``rows`` labelled documents, the smallest by a hash
    of id and text: the one bounded collect of the fit.

    A document counts once for each of its grades, however often it or its label repeats, and
    each has at most 2^bits features.
    """
    known = (labels.select(F.col("doc_id").alias("label_id"), "grade")
             .filter(F.col("grade").between(0, n_grades - 1)).distinct())
    keyed = docs.withColumn("text_key", text_key(F.col("text")))
    key = ["doc_id", "text_key", "grade"]
    chosen = (keyed.select("doc_id", "text_key").join(known, F.col("doc_id") == F.col("label_id")).select(*key).distinct()
              .orderBy(F.xxhash64("doc_id", "text_key"), *key).limit(rows))
    texts = keyed.join(chosen, ["doc_id", "text_key"]).select("text", *key)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py(), bits) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.list_(pa.int32())),
                                              pa.array([f[1] for f in found], pa.list_(pa.float32())), *batch.columns[1:]],
                                             ["cols", "vals", *key])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(work, f"cols array<int>, vals array<float>, doc_id {kind}, text_key bigint, grade int")
    # the order decides the last digits of the sums
    got = found.dropDuplicates(key).toArrow().sort_by([(c, "ascending") for c in key])
    return [(np.asarray(c.values, np.int32), np.asarray(v.values, np.float32), g.as_py())
            for c, v, g in zip(got.column("cols"), got.column("vals"), got.column("grade"))]


def predict_severity(docs: DataFrame, labels: DataFrame, *, n_grades: int = 3, sample_rows: int = 10_000, bits: int = 18,
                     rounds: int = 300, toxic_share: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, expected_severity, p (each grade's probability), grade, toxic.

    ``labels`` has (doc_id, grade), grades from 0 to ``n_grades`` - 1; the fit uses at most
    ``sample_rows`` of them.  ``grade`` is the first one whose cumulative probability is a half
    or more; ``toxic`` says that the probability of a grade above 0 is ``toxic_share`` or more.

    Null and empty texts have no features and get the thresholds' own grades; labels that are
    null, out of range or without a document are left out; repeated labels and documents count
    once in the fit, a document with two grades once for each; where two grades tie, the lower one is
    given; without labels all weights are zero; very long texts count whole; an empty table
    gives no rows; other columns are ignored.
    """
    d = documents(docs, id_col, text_col)
    model = fit(labelled_sample(d, labels, rows=sample_rows, bits=bits, n_grades=n_grades), bits, n_grades, rounds=rounds)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # of fixed size

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*sent.value)
        for batch in batches:
            found = [features(t.as_py(), bits) for t in batch.column(1)]
            p = fitted.grades(np.array([float(fitted.weights[c] @ v) for c, v in found], dtype=float))
            grade = (np.cumsum(p, axis=1)[:, :-1] < 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p @ np.arange(n_grades)), pa.array(list(p), pa.list_(pa.float64())),
                 pa.array(grade.astype(np.int32)), pa.array(p[:, 1:].sum(axis=1) >= toxic_share)],
                ["doc_id", "expected_severity", "p", "grade", "toxic"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(work, f"doc_id {kind}, expected_severity double, p array<double>, grade int, toxic boolean")
