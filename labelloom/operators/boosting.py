"""Gradient boosting of all tags, settings and folds in one job, read off after several numbers of trees.

Trees of depth 3 on binned features, each fitted to the residuals of the trees before it. That is a chain of some hundred
trees, so one (tag, setting, fold) stays in one task: its rows are a tag's sample, which the sample's specification
bounds, and jobs spread over the cluster. Candidate features are the forests' hashes of (tree, node, feature).
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators import forest, passes
from labelloom.operators.forest import BINS

# The searched grid, depth and rate.
TREES = (100, 200, 300)
SUBSETS = ("sqrt", "log2")
MIN_SPLIT = (2, 3)
DEPTH, RATE = 3, 0.1


@dataclass
class Boosted:
    """Trees as rows of nodes, numbered from 1 at the root, children of n at 2n and 2n + 1; 0 is no node."""

    fold: int
    subset: str
    min_split: int
    start: float
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    def accepts(self, x: np.ndarray, bins: np.ndarray) -> np.ndarray:
        return self.margins(bins, (len(self.feature),))[:, 0] > 0

    def margins(self, x: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
        """Log odds of every row after each of the (ascending) numbers of trees."""
        total, out = np.full(len(x), self.start), np.empty((len(x), len(sizes)))
        every = np.arange(len(x))
        for t in range(max(sizes)):
            at = np.ones(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                feature = self.feature[t, at]
                right = x[every, np.maximum(feature, 0)] > self.bin[t, at]
                at = np.where(feature >= 0, 2 * at + right, at)
            total += RATE * self.value[t, at]
            for i, n in enumerate(sizes):
                if n == t + 1:
                    out[:, i] = total
        return out


def best_splits(slot: np.ndarray, values: np.ndarray, residual: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Place among the candidates and cut of every node's best split, or -1: the largest fall of squared error."""
    k = values.shape[1]
    cell = ((slot[:, None] * k + np.arange(k)) * BINS + values).ravel()
    shape = (nodes, k, BINS)
    count = np.bincount(cell, minlength=nodes * k * BINS).reshape(shape).cumsum(axis=2)
    total = np.bincount(cell, np.repeat(residual, k), nodes * k * BINS).reshape(shape).cumsum(axis=2)
    n, s = count[:, :, -1:], total[:, :, -1:]
    left_n, left_s = count[:, :, :-1], total[:, :, :-1]
    right_n, right_s = n - left_n, s - left_s
    gain = np.round(left_s**2 / np.maximum(left_n, 1) + right_s**2 / np.maximum(right_n, 1), 6)
    gain[(left_n == 0) | (right_n == 0)] = -np.inf
    best = gain.reshape(nodes, -1).argmax(axis=1)
    possible = gain.reshape(nodes, -1)[np.arange(nodes), best] > -np.inf
    return np.where(possible, best // (BINS - 1), -1), best % (BINS - 1)


def boost(x: np.ndarray, label: np.ndarray, fold: int, subset: str, min_split: int, trees: int) -> Boosted:
    """``trees`` trees on the rows ``x`` of bins; without rows of both kinds none splits."""
    n, dims = x.shape
    k, size = forest.subset_size(subset, dims), 2 ** (DEPTH + 1)
    positive = label.mean() if n else 0.0
    start = float(np.log(max(positive, 1e-12) / max(1 - positive, 1e-12)))
    model = Boosted(
        fold, subset, min_split, start, np.full((trees, size), -1, np.int32), np.zeros((trees, size), np.uint8), np.zeros((trees, size))
    )
    if not 0 < positive < 1:
        return model
    margin, y = np.full(n, start), label.astype(float)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        residual, at = y - p, np.ones(n, dtype=np.int64)
        for _ in range(DEPTH):
            level, slot = np.unique(at, return_inverse=True)
            features = forest.candidates(np.full(len(level), t), level, dims, k)
            place, cut = best_splits(slot, x[np.arange(n)[:, None], features[slot]], residual, len(level))
            rows = np.bincount(slot, minlength=len(level))
            split = (place >= 0) & (rows >= min_split)
            model.feature[t, level[split]] = features[split, place[split]]
            model.bin[t, level[split]] = cut[split]
            feature = model.feature[t, at]
            at = np.where(feature >= 0, 2 * at + (x[np.arange(n), np.maximum(feature, 0)] > model.bin[t, at]), at)
        up = np.bincount(at, residual, size)
        down = np.bincount(at, p * (1 - p), size)
        model.value[t] = np.where(down > 1e-150, up / np.maximum(down, 1e-150), 0.0)
        margin += RATE * model.value[t, at]
    return model


def grid(tags: DataFrame, folds: int, subsets: Sequence[str] = SUBSETS, min_split: Sequence[int] = MIN_SPLIT) -> DataFrame:
    """A job per tag, fold and setting."""
    every = lambda values: F.explode(F.array(*[F.lit(v) for v in values]))
    jobs = tags.select("tag", every(range(folds)).alias("fold"))
    return jobs.select("*", every(subsets).alias("subset")).select("*", every(min_split).alias("min_split"))


def fit(blocks: DataFrame, jobs: DataFrame, trees: int = max(TREES)) -> DataFrame:
    """States ``(tag, job, active, state)`` of ``jobs (tag, fold, subset, min_split)``, or with ``trees`` of their own, on
    blocks of bins; fold -1 leaves none out."""

    def run(key, table):
        tag, fold, subset, min_split, trees = (k.as_py() for k in key)
        parts = sorted((pickle.loads(b) for b in table.column("data").to_pylist()), key=lambda b: (b.fold, b.ids.tolist()))
        train = [b for b in parts if b.fold != fold]
        dims = parts[0].x.shape[1]
        x = np.concatenate([np.empty((0, dims), np.uint8), *(b.x for b in train)])
        label = np.concatenate([np.empty(0, bool), *(b.label for b in train)])
        order = np.argsort(np.concatenate([np.empty(0, np.int64), *(b.ids for b in train)]), kind="stable")
        model = boost(x[order], label[order], fold, subset, min_split, trees)
        row = [[tag], [f"{subset}:{min_split}:{fold}"], [False], [pickle.dumps(model)]]
        return pa.table([pa.array(c, t) for c, t in zip(row, (pa.string(), pa.string(), pa.bool_(), pa.binary()))], names=names)

    names = ["tag", "job", "active", "state"]
    keys = ("tag", "fold", "subset", "min_split", "trees")
    given = jobs if "trees" in jobs.columns else jobs.withColumn("trees", F.lit(trees))
    here = blocks.select("tag", "data").join(given.select(*keys), "tag")
    return here.groupBy(*keys).applyInArrow(run, passes.STATE)


def _hits(tag: str, block: passes.Block, model: Boosted, sizes: Sequence[int]) -> list[tuple]:
    if block.fold != model.fold:
        return []
    positive = model.margins(block.x, sizes) > 0
    n, real = len(block.label), int(block.label.sum())
    return [
        (tag, model.fold, model.subset, model.min_split, size, n, real, int((p & block.label).sum()), int(p.sum()))
        for size, p in zip(sizes, positive.T)
    ]


def fold_scores(blocks: DataFrame, found: DataFrame, sizes: Sequence[int] = TREES) -> DataFrame:
    """``(tag, model, subset, min_split, trees, fold, n, positives, hits, predicted, f1)`` on left-out folds."""
    schema = (
        "tag string, fold int, subset string, min_split int, trees int, n long, positives long, hits long, predicted long"
    )
    rows = passes.scored(blocks, found, lambda tag, block, state: _hits(tag, block, state, sizes), schema)
    sums = rows.groupBy("tag", "subset", "min_split", "trees", "fold").agg(
        *(F.sum(x).alias(x) for x in ("n", "positives", "hits", "predicted"))
    )
    both = F.col("positives") + F.col("predicted")
    f1 = F.when(both > 0, 2 * F.col("hits") / both).otherwise(0.0)
    return sums.select("*", F.lit("gradient_boosting").alias("model"), f1.alias("f1"))


def first_splits(found: DataFrame) -> DataFrame:
    """``(tag, fold, subset, min_split, feature, bin)``: the root of every job's first tree."""

    def run(batches):
        for batch in batches:
            models = [pickle.loads(b) for b in batch.column("state").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "tag": batch.column("tag"),
                    "fold": pa.array([m.fold for m in models], pa.int32()),
                    "subset": pa.array([m.subset for m in models], pa.string()),
                    "min_split": pa.array([m.min_split for m in models], pa.int32()),
                    "feature": pa.array([m.feature[0, 1] for m in models], pa.int32()),
                    "bin": pa.array([m.bin[0, 1] for m in models], pa.int32()),
                }
            )

    schema = "tag string, fold int, subset string, min_split int, feature int, bin int"
    return found.select("tag", "state").mapInArrow(run, schema)
