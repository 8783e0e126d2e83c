"""Quality rules: fixed ones, and gradient-boosted trees over document statistics.

Trees are complete and of one depth, so that each is a row of three numpy arrays and a level of all rows is one
step. On some statistics the trees may only fall: more symbols or repetitions never make a text better. Where a
split of such a statistic would raise the right side, it is not taken, and the values below stay on
their side of the middle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from barloom.llm.arrow_text import with_columns_in_arrow
from barloom.llm.document_stats import STATISTICS, count
from barloom.llm.labelled import FOLDS, SAMPLE_PER_CLASS, training_labels
from barloom.session import settle

TREES = 60
DEPTH = 3
BINS = 48
RATE = 0.15
L2 = 5.0
LEAST = 20.0        # weight that a side of a split has at least
KEEP = 0.3
#: Statistics on which the score may only fall.
FALLING = ("symbols", "duplicate_lines", "repeated_words", "exclamations", "bars", "symbol_words",
           "capital_words", "top_word")
MIN_WORDS = 10
MOST_REPEATED = 20  # per cent of the words


@dataclass
class Trees:
    """``feature`` and ``cut`` of inner nodes, ``value`` of leaves, one row per tree."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    start: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _grow(binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray,
          falling: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree: features, cuts, leaf values, and the leaf of each row."""
    inner = 2 ** DEPTH - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(binned), np.int64)
    low, high = {0: -np.inf}, {0: np.inf}
    for parent in range(inner):
        rows = np.flatnonzero(node == parent)
        own = binned[rows]
        cells = own + np.arange(own.shape[1]) * BINS
        g = np.bincount(cells.reshape(-1), np.repeat(gradient[rows], own.shape[1]),
                        own.shape[1] * BINS).reshape(-1, BINS)
        h = np.bincount(cells.reshape(-1), np.repeat(hessian[rows], own.shape[1]),
                        own.shape[1] * BINS).reshape(-1, BINS)
        gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
        gt, ht = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
        left = np.clip(-gl / (hl + L2), low[parent], high[parent])
        right = np.clip(-(gt - gl) / (ht - hl + L2), low[parent], high[parent])
        gain = (gl ** 2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt ** 2 / (ht + L2))
        allowed = (hl >= LEAST * 0.05) & (ht - hl >= LEAST * 0.05)
        allowed &= ~(falling[:, None] & (right > left))
        gain = np.where(allowed, gain, 0)
        best = int(gain.argmax()) if gain.size else 0
        a, b = 2 * parent + 1, 2 * parent + 2
        low[a] = low[b] = low[parent]
        high[a] = high[b] = high[parent]
        goes_right = np.zeros(len(rows), bool)
        if gain.size and gain.reshape(-1)[best] > 1e-6:
            f, k = divmod(best, BINS - 1)
            if k < len(edges[f]):
                feature[parent], cut[parent] = f, edges[f][k]
                goes_right = own[:, f] > k
                if falling[f]:
                    middle = (left[f, k] + right[f, k]) / 2
                    low[a], high[b] = middle, middle
        node[rows] = np.where(goes_right, b, a)
    leaves = node - inner
    g = np.bincount(leaves, gradient, inner + 1)
    h = np.bincount(leaves, hessian, inner + 1)
    bounds = [(low[inner + k], high[inner + k]) for k in range(inner + 1)]
    value = np.clip(-g / (h + L2), [x for x, _ in bounds], [y for _, y in bounds])
    return feature, cut, value, leaves


def boost(x: np.ndarray, label: np.ndarray, weight: np.ndarray,
          falling: tuple[str, ...] = FALLING, names: tuple[str, ...] = STATISTICS) -> Trees:
    """Trees for the log odds of label 1, by Newton steps on histograms."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
             for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    falls = np.array([n in falling for n in names])
    share = np.clip((weight * label).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin, grown = np.full(len(x), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        feature, cut, value, leaves = _grow(binned, edges, weight * (p - label),
                                            weight * np.maximum(p * (1 - p), 1e-6), falls)
        margin = margin + RATE * value[leaves]
        grown.append((feature, cut, RATE * value))
    return Trees(*(np.array([t[k] for t in grown]) for k in range(3)), start)


COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("statistics", T.ArrayType(T.DoubleType()))])


def counted(docs: DataFrame, text_col: str = "text", carried: list[str] | None = None) -> DataFrame:
    """``carried`` columns (all, if not given), the exact counts, and ``statistics``."""
    def work(texts: pa.Array) -> list[pa.Array]:
        c = count(texts)
        exact = [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words]
        return [pa.array(v, pa.int64()) for v in exact] + [
            pa.array(c.statistics.tolist(), pa.list_(pa.float64()))]

    return with_columns_in_arrow(docs, text_col, COUNTS, work,
                                 docs.columns if carried is None else carried)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def fit(described: DataFrame, labels: DataFrame, label: str = "quality",
        per_class: int = SAMPLE_PER_CLASS, folds: int = FOLDS) -> Trees | None:
    """Trees from ``(doc_id, statistics)`` of at most ``per_class`` labelled rows of either class,
    chosen by a hash of the id; None if a class is missing."""
    known = described.select("doc_id", "statistics").join(training_labels(labels, label, folds), "doc_id")
    known = settle(known, "labelled")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    key = F.md5(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")).cast("binary"))
    rows = [r for y in (0, 1) for r in known.where(F.col("label") == y)
            .orderBy(key, "doc_id", "statistics").limit(per_class).collect()]
    y = np.array([r["label"] for r in rows])
    weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    return boost(np.array([r["statistics"] for r in rows]), y, weight / weight.mean())


def judged(described: DataFrame, trees: Trees | None, keep: float = KEEP) -> DataFrame:
    """``described`` with ``base_failed``, ``rule_score`` and ``kept``.

    A text that fails the fixed rules goes; others stay if the trees give label 1 at least ``keep``.
    Without trees (no labels of both classes) only the fixed rules decide.
    """
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    if trees is None:
        return described.withColumns({"base_failed": failed, "rule_score": F.lit(1.0), "kept": ~failed})

    @F.pandas_udf("double")
    def score(statistics):
        import pandas as pd

        return pd.Series(trees.scores(np.array(statistics.tolist(), float)))

    scored = described.withColumn("rule_score", score("statistics"))
    return scored.withColumns({"base_failed": failed, "kept": ~failed & (F.col("rule_score") >= keep)})
