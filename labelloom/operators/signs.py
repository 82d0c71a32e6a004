"""Bernoulli naive Bayes on the signs of dense features, all tags, smoothings and folds from one count.

One pass counts positive signs per tag, fold and label; the training side of a fold is the total minus the fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators import passes

# The searched smoothings. A smoothing of 0 is 1e-10.
ALPHAS = (0.0, 1.0, 2.0)
LEAST_ALPHA = 1e-10


@dataclass
class Counts:
    """``counts[fold, label, feature]`` of positive signs; the last place counts rows."""

    counts: np.ndarray
    alpha: float = 1.0

    def weights(self, fold: int, alpha: float) -> tuple[np.ndarray, float]:
        """Log odds as weights of the signs and a bias, learned without ``fold`` (-1: from all)."""
        left = self.counts.sum(axis=0) - (self.counts[fold] if fold >= 0 else 0)
        alpha, n = max(alpha, LEAST_ALPHA), left[:, -1:]
        if n.min() == 0:
            return np.zeros(left.shape[1] - 1), -np.inf if n[1, 0] == 0 else np.inf
        p = (left[:, :-1] + alpha) / (n + 2 * alpha)
        # Logarithms of both shares, each from its own counts: 1 - p loses them next to 1.
        q = (n - left[:, :-1] + alpha) / (n + 2 * alpha)
        yes, no = np.log(p[1]) - np.log(p[0]), np.log(q[1]) - np.log(q[0])
        return yes - no, float(no.sum() + np.log(n[1, 0]) - np.log(n[0, 0]))

    def accepts(self, x: np.ndarray, bins: np.ndarray) -> np.ndarray:
        weights, bias = self.weights(-1, self.alpha)
        return (x > 0) @ weights + bias > 0


def measure(block: passes.Block, state: Counts) -> np.ndarray:
    counts = np.zeros_like(state.counts)
    rows = np.column_stack([block.x > 0, np.ones(len(block.x))])
    for label in (0, 1):
        counts[block.fold, label] = rows[block.label == bool(label)].sum(axis=0)
    return counts


def step(state: Counts, part) -> tuple[Counts, bool]:
    if part is not None:
        state.counts = part
    return state, False


def fit(blocks: DataFrame, tags: DataFrame, folds: int, dims: int) -> DataFrame:
    """States of all ``tags (tag)``, or of ``tags (tag, alpha)`` for final models."""
    alpha = F.col("alpha") if "alpha" in tags.columns else F.lit(1.0)
    jobs = tags.select("tag", F.lit("all").alias("job"), alpha.cast("double").alias("alpha"))
    first = passes.states(jobs, lambda row: Counts(np.zeros((folds, 2, dims + 1)), row["alpha"]))
    return passes.fitted(blocks, first, measure, lambda a, b: a + b, step, 1, weight=lambda p: p.nbytes, name="signs")


def _hits(tag: str, block: passes.Block, state: Counts, alphas: Sequence[float]) -> list[tuple]:
    out = []
    for alpha in alphas:
        weights, bias = state.weights(block.fold, alpha)
        positive = (block.x > 0) @ weights + bias > 0
        n, real = len(block.label), int(block.label.sum())
        out.append((tag, block.fold, alpha, n, real, int((positive & block.label).sum()), int(positive.sum())))
    return out


def fold_scores(blocks: DataFrame, found: DataFrame, alphas: Sequence[float] = ALPHAS) -> DataFrame:
    """``(tag, model, alpha, fold, n, positives, hits, predicted, f1)`` on left-out folds."""
    schema = "tag string, fold int, alpha double, n long, positives long, hits long, predicted long"
    rows = passes.scored(blocks, found, lambda tag, block, state: _hits(tag, block, state, alphas), schema)
    sums = rows.groupBy("tag", "alpha", "fold").agg(*(F.sum(x).alias(x) for x in ("n", "positives", "hits", "predicted")))
    both = F.col("positives") + F.col("predicted")
    f1 = F.when(both > 0, 2 * F.col("hits") / both).otherwise(0.0)
    return sums.select("*", F.lit("bernoulli_nb").alias("model"), f1.alias("f1"))
