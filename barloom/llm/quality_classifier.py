"""Quality by regularised quadratic discriminant analysis of document statistics.

Shares are taken to log odds, everything is centred, scaled and bounded. Each class has a Gaussian
whose covariance is shrunk towards the one that both share and towards a multiple of the identity;
its Cholesky factor is kept, so that a Mahalanobis distance is one triangular product. The
difference of log densities becomes a probability by a logistic curve, as densities of counts are
far from Gaussian and too sure of themselves.

All labelled rows outside the held-out fold take part: only sums leave the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from barloom.llm.arrow_text import with_columns_in_arrow
from barloom.llm.document_stats import STATISTICS, count
from barloom.llm.labelled import FOLDS, training_labels
from barloom.session import settle, ship_package

SHARED = 0.1       # weight of the covariance that both classes share
ROUND = 0.01       # weight of the multiple of the identity
BOUND = 6.0        # standard deviations at which a statistic ends
THRESHOLD = 0.3
_LOGS = [i for i, name in enumerate(STATISTICS) if name in ("log_words", "words_per_line")]
_LENGTHS = [i for i, name in enumerate(STATISTICS) if name == "word_length"]


def transformed(statistics: np.ndarray) -> np.ndarray:
    """Log odds of shares, logarithm of the word length; what is a logarithm stays."""
    out = np.clip(statistics, 0, 1)
    out = np.log((out + 0.002) / (1.002 - out))
    out[:, _LOGS] = statistics[:, _LOGS]
    out[:, _LENGTHS] = np.log1p(statistics[:, _LENGTHS])
    return out


@dataclass
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray      # inverse of the Cholesky factor of the covariance
    log_scale: float        # log prior - log determinant / 2

    @classmethod
    def of(cls, mean: np.ndarray, covariance: np.ndarray, prior: float) -> Gaussian:
        lower = np.linalg.cholesky(covariance)
        return cls(mean, np.linalg.inv(lower), float(np.log(prior) - np.log(np.diag(lower)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        return self.log_scale - 0.5 * (((x - self.mean) @ self.factor.T) ** 2).sum(axis=1)


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    good: Gaussian
    bad: Gaussian
    slope: float = 1.0
    intercept: float = 0.0

    def standard(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip((transformed(statistics) - self.centre) / self.scale, -BOUND, BOUND)

    def difference(self, statistics: np.ndarray) -> np.ndarray:
        """Difference of the log densities, compressed at either end, where it is too sure."""
        x = self.standard(statistics)
        return np.arcsinh(self.good.log_density(x) - self.bad.log_density(x))

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        z = self.slope * self.difference(statistics) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


STATS = T.StructType([T.StructField("statistics", T.ArrayType(T.DoubleType()))])


def with_statistics(docs: DataFrame, text_col: str = "text", carried: list[str] | None = None
                    ) -> DataFrame:
    """``carried`` columns (all, if not given) and ``statistics``, an array in the order of names."""
    def work(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(count(texts).statistics.tolist(), pa.list_(pa.float64()))]

    return with_columns_in_arrow(docs, text_col, STATS, work,
                                 docs.columns if carried is None else carried)


def _moments(labelled: DataFrame, prepare) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class its rows, the sums of the prepared statistics, and of their products."""
    ship_package(labelled.sparkSession)
    width = len(STATISTICS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width + 1, width + 1))
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            x = prepare(matrix(batch.column("statistics")))
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            for y in (0, 1):
                sums[y] += x[label == y].T @ x[label == y]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.reshape(-1))],
                                         ["cell", "total"])

    rows = (labelled.select("label", "statistics").mapInArrow(add, "cell long, total double")
            .groupBy("cell").agg(F.sum("total").alias("total")).collect())
    sums = np.zeros(2 * (width + 1) ** 2)
    for row in rows:
        sums[row["cell"]] = row["total"]
    sums = sums.reshape(2, width + 1, width + 1)
    return {y: (sums[y, 0, 0], sums[y, 0, 1:], sums[y, 1:, 1:]) for y in (0, 1)}


def logistic_curve(points: list[tuple[float, int, float]]) -> tuple[float, float]:
    """Slope and intercept that fit weighted ``(difference, label, weight)`` best (Newton steps)."""
    z, y, w = (np.array(c, float) for c in zip(*points))
    a, b = 0.1, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        error, curve = w * (p - y), w * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(error * z).sum() + 1e-3 * a, error.sum()])
        hessian = np.array([[(curve * z * z).sum() + 1e-3, (curve * z).sum()],
                            [(curve * z).sum(), curve.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-4), float(b)


def fit(described: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS
        ) -> Model | float:
    """The model from ``(doc_id, statistics)``, or the share of label 1 if a class has too few rows."""
    known = training_labels(labels, label, folds)
    labelled = settle(described.join(known, "doc_id").select("label", "statistics"), "labelled")
    first = _moments(labelled, transformed)
    n = {y: first[y][0] for y in (0, 1)}
    if min(n.values()) < 2:
        return float((n[1] + 0.5) / (n[0] + n[1] + 1))
    total = n[0] + n[1]
    centre = (first[0][1] + first[1][1]) / total
    spread = (np.diag(first[0][2]) + np.diag(first[1][2])) / total - centre ** 2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    bounded = _moments(labelled, lambda s: np.clip((transformed(s) - centre) / scale, -BOUND, BOUND))
    means = {y: bounded[y][1] / n[y] for y in (0, 1)}
    own = {y: bounded[y][2] / n[y] - np.outer(means[y], means[y]) for y in (0, 1)}
    shared = sum(n[y] * own[y] for y in (0, 1)) / total
    identity = np.eye(len(STATISTICS))
    classes = {}
    for y in (0, 1):
        covariance = ((1 - SHARED - ROUND) * own[y] + SHARED * shared
                      + ROUND * max(np.trace(own[y]) / len(own[y]), 1e-3) * identity)
        classes[y] = Gaussian.of(means[y], covariance, n[y] / total)
    model = Model(centre, scale, classes[1], classes[0])

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.clip(model.difference(matrix(batch.column("statistics"))), -20, 20)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(np.round(z * 32) / 32)],
                                             ["label", "z"])

    binned = (labelled.mapInArrow(differ, "label int, z double")    # at most 2 * 1281 groups
              .groupBy("label", "z").count().collect())
    model.slope, model.intercept = logistic_curve([(r["z"], r["label"], r["count"]) for r in binned])
    return model


def with_scores(described: DataFrame, model: Model | float) -> DataFrame:
    """All columns of ``described`` and ``quality_score``, 0 to 1."""
    if isinstance(model, float):
        return described.withColumn("quality_score", F.lit(model))
    ship_package(described.sparkSession)
    carried = [c for c in described.columns if c.lower() != "quality_score"]
    schema = T.StructType([described.schema[c] for c in carried]
                          + [T.StructField("quality_score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(model.scores(matrix(batch.column("statistics"))))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [made],
                                             carried + ["quality_score"])

    return described.select(*(f"`{c}`" for c in carried)).mapInArrow(score, schema)
