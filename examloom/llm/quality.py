"""Document quality by a linear classifier on n-grams scaled by class log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.llm import arrays as A
from examloom.llm.features import quality_features
from examloom.llm.labelled import fold, sample


@dataclass(frozen=True)
class QualityModel:
    """Ratios and hinge weights of hashed n-grams, and the scale of scores."""

    bits: int
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, owner: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
        r = self.ratio[index]
        norm = np.sqrt(np.bincount(owner, r * r, n))
        raw = np.bincount(owner, r * self.weight[index], n)
        return raw / np.maximum(norm, 1e-12) + self.bias

    def scores(self, owner: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(owner, index, n) + self.shift, -30, 30)))


def log_count_ratio(y: np.ndarray, at: np.ndarray, index: np.ndarray, size: int, smooth: float = 1.0):
    """log of the ratio of the two classes' smoothed, normalised indicator counts."""
    row = A.owners(at)
    good = np.bincount(index[y[row] > 0], minlength=size) + smooth
    bad = np.bincount(index[y[row] <= 0], minlength=size) + smooth
    return np.log((good / good.sum()) / (bad / bad.sum()))


def dual_coordinate_descent(at, index, value, y, cost, epochs: int, size: int, seed: int = 7):
    """Linear squared-hinge model: coordinates of the dual are updated one row at a time."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(y))
    square = np.add.reduceat(np.append(value * value, 0.0), np.minimum(at[:-1], len(value)))
    square = np.where(np.diff(at) > 0, square, 0) + 1 + 1 / (2 * cost)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            own = slice(at[i], at[i + 1])
            columns, x = index[own], value[own]
            gradient = y[i] * (w[columns] @ x + bias) - 1 + alpha[i] / (2 * cost[i])
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[columns] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def _scaling(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over margins, by Newton steps with smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * theta)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit_quality(
    docs: DataFrame, labels: DataFrame, rows: int = 6_000, bits: int = 18, cost: float = 1.0, epochs: int = 6
) -> QualityModel:
    """A model of ``labels(doc_id, quality)`` from a sample of at most ``rows`` labelled documents.

    Labels of fold 0 are never read. Four fifths of the sample fit the weights,
    the rest the logistic scale. With no labels, or labels of one class only, all
    weights are zero and every score is that class's smoothed share.
    """
    label, at, index = sample(docs, labels, "quality", quality_features, bits, rows)
    size = 1 << bits
    y = np.where(label > 0, 1.0, -1.0)
    if len(np.unique(y)) < 2:
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        void = np.zeros(size)
        return QualityModel(bits, void, void, 0.0, 0.0, float(np.log(share / (1 - share))))
    fitted = np.arange(len(y)) % 5 != 0
    if len(np.unique(y[fitted])) < 2 or len(np.unique(y[~fitted])) < 2:
        fitted[:] = True
    row = A.owners(at)
    own = fitted[row]
    own_at = np.concatenate([[0], np.cumsum(np.diff(at)[fitted])])
    ratio = log_count_ratio(y[fitted], own_at, index[own], size)
    value = ratio[index]
    norm = np.sqrt(np.bincount(row, value * value, len(y)))
    value = value / np.maximum(norm[row], 1e-12)
    share = (y[fitted] > 0).mean()
    costs = cost * np.where(y[fitted] > 0, 0.5 / share, 0.5 / (1 - share))
    w, bias = dual_coordinate_descent(own_at, index[own], value[own], y[fitted], costs, epochs, size)
    margin = np.bincount(row, value * w[index], len(y)) + bias
    rest = ~fitted if (~fitted).any() else fitted
    slope, shift = _scaling(margin[rest], y[rest] > 0)
    return QualityModel(bits, ratio, w, bias, slope, shift)


def _score(shared, keep: list[str], name: str = "quality_score"):
    def run(batches):
        model: QualityModel = shared.value
        for rows, data, borders in A.runs(batches):
            owner, index = quality_features(data, borders, model.bits)
            score = pa.array(model.scores(owner, index, rows.num_rows))
            kept = [rows.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, score], names=[*keep, name])

    return run


def with_score(docs: DataFrame, model: QualityModel, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score as ``name``, in one narrow pass over whole texts.

    Null and empty texts have no n-grams and score as the bias alone. A column of
    ``docs`` that is called ``name`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() != name.lower()])
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    return kept.mapInArrow(_score(shared, kept.columns, name), schema)


def scored(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for each of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = wanted.mapInArrow(_score(shared, ["doc_id"]), "doc_id long, quality_score double")
    return out.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= threshold).cast("int").alias("predicted"),
    )
