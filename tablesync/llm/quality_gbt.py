"""Quality classifier (operator 8): histogram gradient-boosted trees over document statistics.

Statistics are cut into at most 64 bins by quantile; each tree is grown level by level from the histograms of
gradients and hessians of the logistic loss. The trees are complete binary ones, so that they flatten into three arrays
(statistic, threshold, leaf value) and a batch of rows walks all of them with numpy indexing alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import bounded_sample, load, map_batches, staged
from tablesync.llm.stats import COUNT_SCHEMA, FEATURES, count_batch

#: Labelled rows that the trees are fitted on, at most (about; a hash of the id picks them).
SAMPLE_ROWS = 20_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.2
REGULARISE = 1.0
MIN_HESSIAN = 2.0


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``threshold``: tree x inner node, ``leaf``: tree x leaf; ``base``: log odds without trees."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost on rows ``x`` (finite numbers) with labels 0 or 1. With no rows, or one class only, a constant."""
    n, width = x.shape
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    rate = (y.sum() + 1) / (n + 2)
    base = float(np.log(rate / (1 - rate)))
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], 1)
    features, thresholds, values = [], [], []
    odds = np.full(n, base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(count)
            choice = np.full((count, 2), -1)
            for j in range(width):
                key = local * BINS + binned[:, j]
                gs = np.cumsum(np.bincount(key, g, count * BINS).reshape(count, BINS), 1)
                hs = np.cumsum(np.bincount(key, h, count * BINS).reshape(count, BINS), 1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + REGULARISE) + (gt - gs) ** 2 / (ht - hs + REGULARISE) - gt**2 / (ht + REGULARISE)
                gain[(hs < MIN_HESSIAN) | (ht - hs < MIN_HESSIAN)] = 0
                gain[:, len(edges[j]) :] = 0
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                better = top > best + 1e-9
                best[better] = top[better]
                choice[better] = np.stack([np.full(count, j), at], 1)[better]
            for k in range(count):
                if choice[k, 0] >= 0:
                    feature[first + k] = choice[k, 0]
                    threshold[first + k] = edges[choice[k, 0]][choice[k, 1]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -RATE * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + REGULARISE)
        odds = odds + leaf[at]
        features.append(feature), thresholds.append(threshold), values.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def text_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of :data:`FEATURES` per row; a null text counts as empty, other columns are not read."""
    counts = map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), COUNT_SCHEMA, count_batch)
    return counts.selectExpr("doc_id", *(f"double({sql}) AS {name}" for name, sql in FEATURES.items()))


def learns_from(doc_id: F.Column) -> F.Column:
    """Rows that may teach: crc32 of the id as text, modulo 3, is not 1. A null id may not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def fit_quality(features: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on a bounded sample of the labelled rows that may teach; null labels teach nothing."""
    marked = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int"))
    marked = marked.where(learns_from(F.col("doc_id")) & F.col("quality").isin(0, 1))
    sample = bounded_sample(marked, "doc_id", sample_rows)
    rows = features.join(sample, "doc_id").toPandas().sort_values(["doc_id", "quality", "words"], kind="stable")
    return fit_trees(rows[list(FEATURES)].to_numpy(float), rows["quality"].to_numpy(float))


def score_quality(features: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` per row of ``features``; equal rows get equal scores."""

    def each(doc_id, **columns):
        x = np.array([columns[name] for name in FEATURES], float).T.reshape(len(doc_id), len(FEATURES))
        score = trees.score(x)
        return {"doc_id": doc_id, "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    scored = map_batches(features, "doc_id bigint, score double, predicted int", each)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = staged(text_features(load(spark, sf_dir, "documents")), "quality-gbt")
    return score_quality(features, fit_quality(features, load(spark, sf_dir, "labels")))
