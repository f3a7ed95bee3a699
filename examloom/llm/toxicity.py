"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all ordered thresholds:
P(grade > k) = sigmoid(x . w - threshold_k). The output is the expected grade.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A
from examloom.llm.features import stem_features
from examloom.llm.labelled import fold, sample


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class SeverityModel:
    """Shared weights of hashed word stems and the ascending thresholds between grades."""

    bits: int
    weight: np.ndarray
    thresholds: np.ndarray

    def chances(self, owner: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
        """(n, grades - 1): the chance of each document to lie above each threshold."""
        score = np.bincount(owner, self.weight[index], n)
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def severity_grades(toxic: np.ndarray, at: np.ndarray, index: np.ndarray, size: int, grades: int) -> np.ndarray:
    """Ordered grades from yes-or-no labels.

    A document that is not toxic has grade 0. Toxic ones are ranked by how many of
    their features speak for toxicity (smoothed log-odds of at least 2) and dealt
    over grades 1 .. ``grades - 1`` at equal shares; equal counts share a grade.
    """
    row = A.owners(at)
    bad = np.bincount(index[toxic[row] > 0], minlength=size) + 0.5
    good = np.bincount(index[toxic[row] <= 0], minlength=size) + 0.5
    odds = np.log(bad / (toxic > 0).sum()) - np.log(good / (toxic <= 0).sum())
    hits = np.bincount(row, odds[index] >= 2, len(toxic))
    out = np.zeros(len(toxic), np.int64)
    own = np.flatnonzero(toxic > 0)
    cuts = np.quantile(hits[own], np.arange(1, grades - 1) / (grades - 1))
    out[own] = 1 + np.searchsorted(cuts, hits[own], "left")
    return out


def fit_ordinal(at, index, grade, grades: int, size: int, ridge: float = 3e-3, steps: int = 200, rate: float = 0.05):
    """Maximum likelihood by full-gradient Adam steps; thresholds stay ordered by their gaps."""
    row = A.owners(at)
    n, k = len(grade), grades - 1
    balance = np.where(grade > 0, 0.5 / max((grade > 0).mean(), 1e-9), 0.5 / max((grade == 0).mean(), 1e-9))
    w = np.zeros(size)
    gaps = np.concatenate([[2.0], np.zeros(k - 1)])  # first threshold, then log gaps
    moments = [[np.zeros(size), np.zeros(size)], [np.zeros(k), np.zeros(k)]]
    for step in range(1, steps + 1):
        cuts = gaps[0] + np.concatenate([[0], np.cumsum(np.exp(gaps[1:]))])
        above = np.ones((n, k + 2))
        above[:, 1:-1] = _sigmoid(np.bincount(row, w[index], n)[:, None] - cuts)
        above[:, -1] = 0
        slope = above * (1 - above)
        rows = np.arange(n)
        chance = np.maximum(above[rows, grade] - above[rows, grade + 1], 1e-12)
        pull = balance * (slope[rows, grade] - slope[rows, grade + 1]) / chance / n
        g_w = -np.bincount(index, pull[row], size) + ridge * w
        g_cut = np.zeros(k)
        np.add.at(g_cut, grade[grade > 0] - 1, (balance * slope[rows, grade] / chance / n)[grade > 0])
        low = grade < k
        np.add.at(g_cut, grade[low], -(balance * slope[rows, grade + 1] / chance / n)[low])
        tails = np.cumsum(g_cut[::-1])[::-1]
        g_gaps = np.concatenate([[tails[0]], tails[1:] * np.exp(gaps[1:])])
        for value, gradient, (m, v) in ((w, g_w, moments[0]), (gaps, g_gaps, moments[1])):
            m += 0.1 * (gradient - m)
            v += 0.001 * (gradient * gradient - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return w, gaps[0] + np.concatenate([[0], np.cumsum(np.exp(gaps[1:]))])


def fit_severity(
    docs: DataFrame, labels: DataFrame, rows: int = 6_000, bits: int = 19, grades: int = 4, least_docs: int = 2
) -> SeverityModel:
    """A model of ``labels(doc_id, toxic)`` from a sample of at most ``rows`` labelled documents.

    Labels of fold 0 are never read, so they measure the model. Features of fewer
    than ``least_docs`` documents of the sample have no weight. Without labels,
    or with labels of one class only, all weights are zero and thresholds stand
    at plus or minus 10: every document has the one grade seen (0 if none).
    """
    toxic, at, index = sample(docs, labels, "toxic", stem_features, bits, rows)
    size = 1 << bits
    if len(np.unique(toxic > 0)) < 2:
        level = 10.0 if not len(toxic) or toxic[0] <= 0 else -10.0
        return SeverityModel(bits, np.zeros(size), np.full(grades - 1, level))
    grade = severity_grades(toxic, at, index, size, grades)
    used = np.flatnonzero(np.bincount(index, minlength=size) >= least_docs)
    number = np.full(size, -1)
    number[used] = np.arange(len(used))
    seen = number[index] >= 0
    own_at = np.searchsorted(A.owners(at)[seen], np.arange(len(at)))
    w, cuts = fit_ordinal(own_at, number[index[seen]], grade, grades, len(used))
    weight = np.zeros(size)
    weight[used] = w
    return SeverityModel(bits, weight, cuts)


def _score(shared):
    def run(batches):
        model: SeverityModel = shared.value
        for rows, data, borders in A.runs(batches):
            owner, index = stem_features(data, borders, model.bits)
            above = model.chances(owner, index, rows.num_rows)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(above[:, 0].copy())],
                names=["doc_id", "expected_severity", "toxic_score"],
            )

    return run


def severities(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """Expected severity of ``docs(doc_id, text)``.

    Returns doc_id, held_out, expected_severity (0 to grades - 1), grade (that
    value rounded), toxic_score (chance of a grade above 0) and toxic (chance at
    least one half). One narrow pass over whole texts. Null and empty texts have
    no features and score as the thresholds alone. Further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = wanted.mapInArrow(_score(shared), "doc_id long, expected_severity double, toxic_score double")
    return out.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "expected_severity",
        F.round("expected_severity").cast("int").alias("grade"),
        "toxic_score",
        (F.col("toxic_score") >= 0.5).alias("toxic"),
    )
