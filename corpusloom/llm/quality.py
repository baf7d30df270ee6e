"""Quality classifier: regularised quadratic discriminant over document statistics.

A document is its statistics (logarithms of the mean and spread of word lengths; shares of short
words, of words that repeat the one before and of kinds of characters, as arcsine of square roots).  Each class has a mean and a covariance, shrunk towards the pooled one
and towards the sphere; Cholesky factors of both are computed once and shipped to the tasks, which
score a document by the difference of the two Mahalanobis log-densities.  The log-priors are equal.

It is fitted on at most ``fit_rows`` labelled documents, those of the smallest hashes; scoring
covers all.  Defined cases: a null text is scored as an empty one; null ids are scored too; documents
with no label, or a null one, aren't fitted on, repeated labels of an id take their minimum; repeated rows get a row each;
if a class has no labelled document, the score is null and everything is kept; ties (score equal
to the threshold) are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import _const, raw, release, slices, tidy, words

FIT_ROWS = 20_000
SHRINK = 0.3
RIDGE = 0.1
#: A document is kept if its log-density under the good class is at least this above that under the bad one.
THRESHOLD = 0.0
_KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r", "\n", ".,;:?'\"()-", "!", "|", "#$%&*@^~`+=<>{}[]\\/_")
#: Bytes and words of an usual text that each text starts from, and shares of the kinds in it.
_USUAL_BYTES, _USUAL_WORDS = 96, 16
_USUAL_SHARES = (0.78, 0.02, 0.0, 0.16, 0.005, 0.02, 0.0, 0.0, 0.0, 0.015)


def _kinds() -> np.ndarray:
    t = np.full(256, len(_KINDS), np.uint8)  # the last kind: bytes of letters beyond ASCII
    for k, chars in enumerate(_KINDS):
        t[list(chars.encode())] = k
    t[:32][t[:32] == len(_KINDS)] = 8
    return t


def statistics(arr: pa.Array) -> np.ndarray:
    """(rows, features) of transformed statistics."""
    buf, off = raw(arr)
    n, kinds = len(off) - 1, len(_KINDS) + 1
    size = np.diff(off)
    row = np.repeat(np.arange(n, dtype=np.int32), size)
    count = np.bincount(row * kinds + _const("kinds", _kinds)[buf], minlength=n * kinds).reshape(n, kinds).astype(float)
    h, length, woff = words(arr)
    n_words = np.diff(woff)
    wrow = np.repeat(np.arange(n), n_words)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (wrow[1:] == wrow[:-1])
    # a short text has little to tell: each statistic starts from some usual bytes and words
    w = n_words + _USUAL_WORDS
    total = size + _USUAL_BYTES
    mean = (np.bincount(wrow, length, n) + 5.0 * _USUAL_WORDS) / w
    square = (np.bincount(wrow, length * length, n) + 34.0 * _USUAL_WORDS) / w
    short = (np.bincount(wrow, length <= 3, n) + 0.4 * _USUAL_WORDS) / w
    repeated = np.bincount(wrow, again, n) / w
    shares = (count + _USUAL_BYTES * np.array(_USUAL_SHARES)) / total[:, None]
    parts = np.column_stack([short, repeated, np.minimum(1, (n_words + _USUAL_BYTES / 6) / total), shares])
    return np.column_stack([np.log(mean), np.log(np.sqrt(np.maximum(square - mean**2, 0)) + 1), np.arcsin(np.sqrt(parts))])


class Model:
    """Means and Cholesky factors of the two classes, after scaling by the pooled deviation."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float = SHRINK, ridge: float = RIDGE) -> None:
        n = sum(m[0] for m in moments.values())
        cov = {k: ss / c - np.outer(s / c, s / c) for k, (c, s, ss) in moments.items()}
        pooled = sum(moments[k][0] * cov[k] for k in cov) / n
        self.scale = 1 / np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        z = np.outer(self.scale, self.scale)
        self.mean, self.inverse, self.constant = {}, {}, {}
        for k, (c, s, _) in moments.items():
            sigma = ((1 - shrink) * cov[k] + shrink * pooled) * z
            sigma = (1 - ridge) * sigma + ridge * np.trace(sigma) / len(sigma) * np.eye(len(sigma))
            factor = np.linalg.cholesky(sigma)
            self.mean[k] = s / c * self.scale
            self.inverse[k] = np.linalg.inv(factor)
            self.constant[k] = -np.log(np.diag(factor)).sum()

    def density(self, x: np.ndarray, k: int) -> np.ndarray:
        z = (x * self.scale - self.mean[k]) @ self.inverse[k].T
        return self.constant[k] - 0.5 * (z * z).sum(axis=1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi in slices(batch.column(1), 1 << 20):
            x = statistics(batch.column(1)[lo:hi])
            for k in (0, 1):
                y = x[label[lo:hi] == k]
                t = total.setdefault(k, [0.0, 0.0, 0.0])
                t[0], t[1], t[2] = t[0] + len(y), t[1] + y.sum(axis=0), t[2] + y.T @ y
    rows = [(k, [t[0], *t[1], *t[2].ravel()]) for k, t in total.items() if t[0]]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.list_(pa.float64()))], ["label", "sums"])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", shrink: float = SHRINK, ridge: float = RIDGE) -> Model | None:
    """The model, or None if a class has no labelled document."""
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__label"))
        .where("__id is not null and __label in (0, 1)")
        .groupBy("__id")
        .agg(F.min("__label").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(fit_rows)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(chosen), "__id")  # fit_rows rows at most
    moments: dict[int, list] = {}
    for r in rows.select("__label", "__text").mapInArrow(tidy(_moments), "label int, sums array<double>").collect():
        sums = np.array(r["sums"])
        moments[r["label"]] = sums + moments.get(r["label"], 0.0)
    if len(moments) < 2:
        return None
    d = int((np.sqrt(4 * len(moments[0]) - 3) - 1) / 2)
    return Model({k: (s[0], s[1 : d + 1], s[d + 1 :].reshape(d, d)) for k, s in moments.items()}, shrink, ridge)


def _score(arr: pa.Array, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    x = statistics(arr)
    return model.density(x, 1), model.density(x, 0)


def _score_batches(batches: Iterator[pa.RecordBatch], model: Model | None, threshold: float) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "log_good", "log_bad", "score", "keep"]
    for batch in batches:
        for lo, hi in slices(batch.column(1), 1 << 20):
            ids = batch.column(0)[lo:hi]
            if model is None:
                none = pa.nulls(hi - lo, pa.float64())
                yield pa.RecordBatch.from_arrays([ids, none, none, none, pa.array(np.ones(hi - lo, bool))], names)
                continue
            good, bad = _score(batch.column(1)[lo:hi], model)
            yield pa.RecordBatch.from_arrays([ids, pa.array(good), pa.array(bad), pa.array(good - bad), pa.array(good - bad >= threshold)], names)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, log_good, log_bad, score, keep) of every document."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tidy(partial(_score_batches, model=model, threshold=threshold)), "doc_id long, log_good double, log_bad double, score double, keep boolean")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", **options) -> DataFrame:
    """*docs* without what the classifier rejects; the texts are scored where they are, without a join."""
    model = fit(docs, labels, text_col=text_col, **options)
    if model is None:
        return docs

    @F.arrow_udf("boolean")
    def good(text: pa.Array) -> pa.Array:
        out = []
        for lo, hi in slices(text, 1 << 20):
            a, b = _score(text[lo:hi], model)
            out.append(a - b >= threshold)
        kept = pa.array(np.concatenate(out) if out else np.zeros(0, bool))
        release()
        return kept

    return docs.where(good(F.col(text_col)))
