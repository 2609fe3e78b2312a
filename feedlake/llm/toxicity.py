"""Toxicity grades by cumulative-link (proportional odds) regression on sparse words.

A document is its set of words and of the words' first four to six letters (a stem
carries a word through its endings). Grades run from 0 (clean) to K; the model shares one
weight per word across the ordered thresholds, P(grade >= k) = logistic(w.x - t_k),
and the output is the expected grade, the sum of these chances. Words enter the model
by their likelihood ratio between toxic and clean rows. The fit uses at most ``SAMPLE``
labelled rows (those with the smallest hashes of their keys, so a run can be repeated),
which bounds the ids that are broadcast and what the driver holds.

Where labels only say toxic or clean, toxic rows are graded by how plainly other rows
give them away: the rows are dealt into ``FOLDS`` folds by their words, a two-grade model
of the other folds gives each toxic row a margin, and the rows of the lowest third of
margins are of grade 1, the next of grade 2, the others of grade 3 (equal margins share
the lower grade). No row's grade thus comes from weights that it helped to fit.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import stored

#: Bounds of the model and of the fit.
WORDS, SAMPLE = 4096, 40_000
#: Rows that must hold a word, and its least likelihood ratio (chi-square at about 1e-6).
LEAST_ROWS, LEAST_RATIO = 5, 24.0
RIDGE = 1.0
#: Folds of the margins, and the grades that toxic rows are parted into.
FOLDS, GRADES = 3, 3

_word = re.compile(r"[^\W\d_]+").findall


def words(text: str | None) -> set[str]:
    """The features of a text; a stem is written with a star."""
    found = set(_word((text or "").lower()))
    return found | {w[:n] + "*" for n in (4, 5, 6) for w in found if len(w) >= n}


@dataclass
class OrdinalModel:
    """Words with their shared weights, and ascending thresholds of the grades 1 to K."""

    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k from 1 to K; not increasing in k."""
        z = self.weights[[self.index[w] for w in words(text) & self.index.keys()]].sum()
        return 1 / (1 + np.exp(self.thresholds - z))


def word_counts(rows: DataFrame, text: str, grade: str) -> DataFrame:
    """``word, n0, n1``: training rows with grade 0, and above 0, that hold the word. Tasks pre-add their rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(sums):
            return pa.RecordBatch.from_arrays([pa.array(sums[0] | sums[1], pa.string()),
                                               *[pa.array([s[w] for w in sums[0] | sums[1]], pa.int64()) for s in sums]],
                                              names=["word", "n0", "n1"])
        sums = (Counter(), Counter())
        for batch in batches:
            for value, g in zip(batch.column(0), batch.column(1).to_pylist()):
                sums[g > 0].update(words(value.as_py()))
                if len(sums[0]) + len(sums[1]) > 200_000:
                    yield out(sums)
                    sums = (Counter(), Counter())
        yield out(sums)

    return (rows.select(text, grade).mapInArrow(run, "word string, n0 long, n1 long")
            .groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def choose_words(counts: DataFrame, clean: int, toxic: int, most: int = WORDS) -> DataFrame:
    """``word, ratio``: the ``most`` words with the largest likelihood ratio (G squared), ties to the smaller word."""
    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    n, all_rows = F.col("n0") + F.col("n1"), float(clean + toxic)
    ratio = 2 * (term(F.col("n0"), n * clean / all_rows) + term(F.col("n1"), n * toxic / all_rows)
                 + term(clean - F.col("n0"), (all_rows - n) * clean / all_rows)
                 + term(toxic - F.col("n1"), (all_rows - n) * toxic / all_rows))
    return (counts.where(n >= LEAST_ROWS).withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
            .orderBy(F.desc("ratio"), "word").limit(most))


def fit_weights(rows: list[np.ndarray], grades: np.ndarray, n_words: int, ridge: float = RIDGE,
                rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps (Adam) on the ridge-penalised cumulative-link likelihood."""
    top = max(1, int(grades.max(initial=0)))
    flat = np.concatenate(rows) if rows else np.zeros(0, int)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows]).astype(int)
    share = np.array([np.clip((grades >= k).mean(), 1e-4, 1 - 1e-4) for k in range(1, top + 1)])
    w, t = np.zeros(n_words), np.log((1 - share) / share)
    first, second = np.zeros(n_words + top), np.zeros(n_words + top)
    row = np.arange(len(grades))
    for step in range(1, rounds + 1):
        z = np.bincount(of, w[flat], minlength=len(rows))
        # bounds: P(grade >= 0) = 1 and P(grade >= top + 1) = 0
        above = np.column_stack([np.ones(len(z)), 1 / (1 + np.exp(np.clip(t[None, :] - z[:, None], -40, 40))), np.zeros(len(z))])
        slope = above * (1 - above)
        low, high = above[row, grades], above[row, grades + 1]
        p = np.maximum(low - high, 1e-9)
        dz = (slope[row, grades] - slope[row, grades + 1]) / p
        gw = np.bincount(flat, dz[of], minlength=n_words) - ridge * w
        gt = np.array([((grades + 1 == k) * slope[row, np.minimum(grades + 1, top)] / p).sum()
                       - ((grades == k) * slope[row, grades] / p).sum() for k in range(1, top + 1)])
        g = np.r_[gw, gt] / max(1, len(rows))
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, t = w + move[:n_words], np.maximum.accumulate(t + move[n_words:])
    return w, t


def sample_labels(labels: DataFrame, key: str, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` labelled rows, by the smallest hashes of their keys."""
    return labels.orderBy(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), *labels.columns).limit(most)


def word_numbers(rows: DataFrame, text: str, label: str, index: dict[str, int]) -> DataFrame:
    """``at, grade, fold``: the numbers of a row's words in the model, its label, and the fold that its words fall in,
    so that rows of the same words share a fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [sorted(index[w] for w in words(t.as_py()) & index.keys()) for t in batch.column(0)]
            fold = [zlib.crc32(np.array(a, "<i4").tobytes()) % FOLDS for a in at]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), batch.column(1), pa.array(fold, pa.int32())],
                                             names=["at", "grade", "fold"])

    return rows.select(text, label).mapInArrow(run, "at array<int>, grade int, fold int")


def fold_margins(numbered: DataFrame, n_words: int) -> DataFrame:
    """``at, grade, margin``: each toxic row with the log odds of toxicity that the other folds' rows give it. A task
    holds the bounded sample's word numbers once."""
    def run(part: pa.Table) -> pa.Table:
        own = part.column("of").to_numpy()
        at = [np.array(a, int) for a in part.column("at").to_pylist()]
        fold, grades = part.column("fold").to_numpy(), part.column("grade").to_numpy()
        order = sorted(np.flatnonzero(fold != own).tolist(), key=lambda i: (grades[i], at[i].tolist()))  # one order, one sum
        w, t = fit_weights([at[i] for i in order], (grades[order] > 0).astype(int), n_words, rounds=150)
        asked = np.flatnonzero((fold == own) & (grades > 0))
        margins = [float(w[at[i]].sum() - t[0]) for i in asked]
        taken = part.take(pa.array(asked)).select(["at", "grade"])
        return taken.append_column("margin", pa.array(margins, pa.float64()))

    folds = numbered.withColumn("of", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1))))
    # clean rows train the other folds only; toxic rows are asked in their own
    return (folds.where((F.col("of") != F.col("fold")) | (F.col("grade") > 0))
            .groupBy("of").applyInArrow(run, "at array<int>, grade int, margin double"))


def margin_grades(margins: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Grades from 1 by equal shares of the margins; equal margins share the lower grade."""
    if not len(margins):
        return np.zeros(0, int)
    cuts = np.quantile(margins, np.arange(1, grades) / grades, method="inverted_cdf")
    cut = np.searchsorted(np.unique(cuts), margins, side="left")
    return 1 + cut


def fit(rows: DataFrame, text: str = "text", label: str = "label", graded: bool = False, most: int = WORDS) -> OrdinalModel:
    """From a bounded sample of rows with a text and a label; rows with a null one are left out.

    ``graded``: the labels are grades from 0; otherwise 0 is clean, others are toxic
    and their grades come from cross-fitted margins. Without rows of both kinds the
    model has no words and gives every text the same grade. Repeated rows count each
    time and share a fold; null keys and extra columns do not matter.
    """
    rows = rows.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(text, F.col(label).cast("int").alias(label))
    n = {bool(r[0]): r[1] for r in rows.groupBy(F.col(label) > 0).count().collect()}
    clean, toxic = n.get(False, 0), n.get(True, 0)
    if not clean or not toxic:
        return OrdinalModel({}, np.zeros(0), np.array([40.0 if not toxic else -40.0]))
    chosen = choose_words(word_counts(rows, text, label), clean, toxic, most).collect()
    index = {r["word"]: i for i, r in enumerate(chosen)}
    numbered = word_numbers(rows, text, label, index)
    if not graded:
        numbered = stored(numbered, "toxicity-words")
        margins = fold_margins(numbered, len(chosen)).toPandas()
        clean_rows = numbered.where("grade <= 0").select("at", F.lit(0).alias("grade")).toPandas()
        pairs = [(0, tuple(a)) for a in clean_rows["at"]]
        pairs += zip(margin_grades(margins["margin"].to_numpy()).tolist(), map(tuple, margins["at"]))
    else:
        picked = numbered.toPandas()  # the bounded sample's word numbers
        pairs = zip(picked["grade"], map(tuple, picked["at"]))
    pairs = sorted(pairs)  # one order, one sum
    w, t = fit_weights([np.array(a, int) for _, a in pairs], np.array([g for g, _ in pairs], int), len(chosen))
    return OrdinalModel(index, w, t)


def predict(docs: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, expected_severity, grade`` for every row; no shuffle.

    ``score`` is P(grade >= 1), ``grade`` the most likely grade (ties: the smaller).
    A null or empty text has no words, so the model's base chances. Repeated rows
    are judged one by one; extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            above = np.array([sent.value.chances(t.as_py()) for t in batch.column(1)]).reshape(batch.num_rows, -1)
            each = -np.diff(np.column_stack([np.ones(len(above)), above, np.zeros(len(above))]), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(above[:, 0]), pa.array(above.sum(axis=1)),
                                              pa.array(each.argmax(axis=1), pa.int32())],
                                             names=[key, "score", "expected_severity", "grade"])

    picked = docs.select(key, text)
    return picked.mapInArrow(run, f"{key} {picked.schema[0].dataType.simpleString()}, score double, expected_severity double, grade int")
