"""Quality scores by a regularised quadratic discriminant over document statistics.

A document becomes a short vector of transformed statistics of its whole text. Each
class gets a mean and a covariance, shrunk towards the pooled covariance and then
towards a multiple of the identity; the score is the logistic of the difference of
the two log densities (Mahalanobis distance and log determinant) plus the log odds of
the classes. Counts, sums and sums of products are added up by Spark, so the fit uses
every labelled row and brings 2 * (1 + p + p * p) numbers to the driver. The Cholesky
factors are computed once and sent with the scoring tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

FEATURES = ("log_bytes", "log_words", "word_length", "upper", "digits", "marks", "stops", "bars", "white", "lines",
            "high", "distinct_words", "common_words", "longest_word")
#: Share of the pooled covariance in a class's covariance, and of the identity in the result.
POOLED, IDENTITY = 0.1, 0.02

_KIND = np.full(256, 5, np.uint8)  # 5: other marks
for _kind, _bytes in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b" \t\n\v\f\r", range(0x80, 0x100))):
    _KIND[list(_bytes)] = _kind
_KIND[list(b".,;:'\"-")] = 6
_KIND[ord("|")] = 7


def statistics(text: str | None) -> list[float]:
    """The vector of FEATURES; a null or empty text has that of no bytes and no words."""
    data = (text or "").encode()
    kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=8) if data else np.zeros(8, int)
    lower, upper, digits, white, high, marks, stops, bars = kinds.tolist()
    words = data.lower().split()
    n, w = max(1, len(data)), max(1, len(words))
    distinct = len(set(words))
    letters = max(1, lower + upper + high)
    return [np.log1p(len(data)), np.log1p(len(words)), np.log1p((len(data) - white) / w), np.sqrt(upper / letters),
            np.sqrt(digits / n), np.sqrt(marks / n), np.sqrt(stops / n), np.sqrt(bars / n), np.sqrt(white / n),
            np.sqrt(data.count(b"\n") / w), np.sqrt(high / letters), np.log((distinct + 1) / (w + 1)),
            np.sqrt(sum(len(x) <= 3 for x in words) / w), np.log1p(max(map(len, words), default=0))]


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, x``: the statistics of every row's whole text; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([statistics(t.as_py()) for t in batch.column(1)],
                                                                        pa.list_(pa.float64()))], names=[key, "x"])

    picked = docs.select(key, text)
    return picked.mapInArrow(run, f"{key} {picked.schema[0].dataType.simpleString()}, x array<double>")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of the classes 0 and 1, and the log odds of 1."""

    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        density = [-0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.logdets)]
        return 1 / (1 + np.exp(np.clip(-(density[1] - density[0] + self.log_odds), -500, 500)))


def fit(rows: DataFrame, label: str, x: str = "x", pooled: float = POOLED, identity: float = IDENTITY) -> Discriminant | None:
    """From rows with a statistics vector and a label 0 or 1 (others are left out). None without both classes."""
    p = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + p + p * p))
        for batch in batches:
            of = batch.column(1).to_numpy(zero_copy_only=False)
            vectors = batch.column(0).flatten().to_numpy().reshape(-1, p)
            for c in (0, 1):
                v = vectors[of == c]
                sums[c] += np.r_[len(v), v.sum(axis=0), (v.T @ v).ravel()]
        at = np.arange(sums[0].size)
        for c in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(at), pa.int32()), pa.array(at, pa.int32()),
                                              pa.array(sums[c])], names=["c", "at", "v"])

    used = rows.where(F.col(label).isin(0, 1)).select(x, F.col(label).cast("int").alias("_label"))
    found = used.mapInArrow(run, "c int, at int, v double").groupBy("c", "at").agg(F.sum("v").alias("v")).toPandas()
    sums = np.zeros((2, 1 + p + p * p))
    sums[found["c"], found["at"]] = found["v"]
    n = sums[:, 0]
    if not n.all():
        return None
    means = sums[:, 1:p + 1] / n[:, None]
    scatter = sums[:, p + 1:].reshape(2, p, p) - n[:, None, None] * means[:, :, None] * means[:, None, :]
    within = scatter.sum(axis=0) / n.sum()
    factors, logdets = [], []
    for c in (0, 1):
        mixed = (1 - pooled) * scatter[c] / n[c] + pooled * within
        # the identity is scaled by feature, so that a rare mark's small variance is not drowned
        shrunk = (1 - identity) * mixed + identity * np.diag(np.diag(within) + 1e-6)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        logdets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(logdets), float(np.log(n[1] / n[0])))


def score(rows: DataFrame, model: Discriminant | None, key: str = "doc_id", x: str = "x") -> DataFrame:
    """``key, score`` for every row of ``features``; 0.5 without a model. Empty texts are scored as any other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            got = model.score(vectors) if model else np.full(len(vectors), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=[key, "score"])

    picked = rows.select(key, x)
    return picked.mapInArrow(run, f"{key} {picked.schema[0].dataType.simpleString()}, score double")
