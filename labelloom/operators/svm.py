"""Linear support vector machines of all tags, all C and all folds in one run.

The loss is the squared hinge with an L2 penalty, intercept included: ``|w|^2 / 2 + C * sum max(0, 1 - y w.x)^2``.
Every (tag, fold) is a job of one column per C. A pass scores each stored block against all columns of its tag, adds up
losses, gradients and the second derivatives over rows inside the margin, and takes a damped Newton step per column; a
column whose gradient is small enough leaves.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators import passes

# The searched costs and the limit of iterations.
C_VALUES = tuple(10.0**e for e in range(9))
MAX_ITER = 100
TOLERANCE = 1e-6
NO_FOLD = -1


@dataclass
class State:
    """Columns of one job: accepted weights, the steps tried from them, and which are still at work."""

    fold: int
    c: np.ndarray
    w: np.ndarray
    step: np.ndarray
    size: np.ndarray
    loss: np.ndarray
    slope: np.ndarray
    least: np.ndarray
    done: np.ndarray
    passes: int = 0

    @property
    def tried(self) -> np.ndarray:
        return self.w + self.size[:, None] * self.step

    def accepts(self, x: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Rows on the positive side of the first column."""
        return with_one(x) @ self.w[0] > 0


def first_state(fold: int, c_values: Sequence[float], dims: int) -> State:
    k, zeros = len(c_values), np.zeros((len(c_values), dims + 1))
    return State(
        fold, np.array(c_values), zeros, zeros.copy(), np.ones(k), np.full(k, np.inf), np.zeros(k), np.zeros(k), np.zeros(k, bool)
    )


def with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def measure(block: passes.Block, state: State):
    """Losses, gradients and second derivatives (upper triangles) that a training block adds to the columns at work."""
    if block.fold == state.fold:
        return None
    at = np.flatnonzero(~state.done)
    x, y = with_one(block.x), np.where(block.label, 1.0, -1.0)
    short = np.maximum(1.0 - y[:, None] * (x @ state.tried[at].T), 0.0)
    c = state.c[at]
    upper = np.triu_indices(x.shape[1])
    curve = np.empty((len(at), len(upper[0])))
    for i in range(len(at)):
        inside = x[short[:, i] > 0]
        curve[i] = 2 * c[i] * (inside.T @ inside)[upper]
    return c * (short * short).sum(axis=0), -2 * c[:, None] * ((short * y[:, None]).T @ x), curve


def add(one, two):
    return tuple(a + b for a, b in zip(one, two))


def step(state: State, part) -> tuple[State, bool]:
    """The next state: a step that lowered the loss enough is taken, another is halved."""
    at = np.flatnonzero(~state.done)
    if part is None:  # no training row at all
        state.done[:] = True
        return state, False
    dims = state.w.shape[1]
    upper = np.triu_indices(dims)
    state.passes += 1
    for i, loss, slope, flat in zip(at, *part):
        tried = state.w[i] + state.size[i] * state.step[i]
        value = 0.5 * tried @ tried + loss
        if value > state.loss[i] + 1e-4 * state.size[i] * state.slope[i]:
            state.size[i] /= 2
            state.done[i] = state.size[i] < 1e-10
            continue
        gradient = tried + slope
        curve = np.zeros((dims, dims))
        curve[upper] = flat
        curve += np.triu(curve, 1).T
        curve[np.diag_indices(dims)] += 1.0
        steep = np.sqrt(gradient @ gradient)
        if state.passes == 1:
            state.least[i] = TOLERANCE * steep
        state.w[i], state.loss[i] = tried, value
        if steep <= state.least[i]:
            state.done[i], state.step[i] = True, 0.0
        else:
            state.step[i] = np.linalg.solve(curve, -gradient)
            state.size[i], state.slope[i] = 1.0, gradient @ state.step[i]
    return state, not state.done.all()


def fit(blocks: DataFrame, jobs: DataFrame, dims: int, max_iter: int = MAX_ITER) -> DataFrame:
    """States of ``jobs (tag, fold, c_values ARRAY)``; a fold of -1 trains on all rows."""
    named = jobs.select("tag", F.col("fold").cast("string").alias("job"), F.col("fold").cast("int").alias("fold"), "c_values")
    first = passes.states(named, lambda row: first_state(row["fold"], row["c_values"], dims))
    return passes.fitted(blocks, first, measure, add, step, max_iter, weight=lambda p: sum(a.nbytes for a in p), name="svm")


def grid(tags: DataFrame, folds: int, c_values: Sequence[float] = C_VALUES) -> DataFrame:
    """A job per tag and fold, with all costs."""
    every = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold")
    costs = F.array(*[F.lit(float(c)) for c in c_values]).alias("c_values")
    return tags.select("tag", every).select("tag", "fold", costs)


def margins(state: State, x: np.ndarray) -> np.ndarray:
    return with_one(x) @ state.w.T


def _hits(tag: str, block: passes.Block, state: State) -> list[tuple]:
    if block.fold != state.fold:
        return []
    positive = margins(state, block.x) > 0
    hits = (positive & block.label[:, None]).sum(axis=0)
    rows = zip(state.c.tolist(), hits.tolist(), positive.sum(axis=0).tolist())
    return [(tag, state.fold, c, len(block.label), int(block.label.sum()), h, p) for c, h, p in rows]


def fold_scores(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """``(tag, model, c, fold, n, positives, hits, predicted, f1)`` on the rows of the fold that a job left out."""
    schema = "tag string, fold int, c double, n long, positives long, hits long, predicted long"
    counted = passes.scored(blocks, found, _hits, schema).groupBy("tag", "c", "fold")
    sums = counted.agg(*(F.sum(x).alias(x) for x in ("n", "positives", "hits", "predicted")))
    both = F.col("positives") + F.col("predicted")
    f1 = F.when(both > 0, 2 * F.col("hits") / both).otherwise(0.0)
    return sums.select("tag", F.lit("linear_svc").alias("model"), "c", "fold", "n", "positives", "hits", "predicted", f1.alias("f1"))


def models(found: DataFrame) -> DataFrame:
    """``(tag, fold, c, weights, bias, passes, converged)`` of every column."""

    def run(batches):
        for batch in batches:
            for tag, blob in zip(batch.column("tag").to_pylist(), batch.column("state").to_pylist()):
                s = pickle.loads(blob)
                yield pa.RecordBatch.from_pydict(
                    {
                        "tag": [tag] * len(s.c),
                        "fold": pa.array([s.fold] * len(s.c), pa.int32()),
                        "c": s.c,
                        "weights": pa.array(list(s.w[:, :-1]), pa.list_(pa.float64())),
                        "bias": s.w[:, -1],
                        "passes": pa.array([s.passes] * len(s.c), pa.int32()),
                        "converged": s.done,
                    }
                )

    return found.mapInArrow(
        run, "tag string, fold int, c double, weights array<double>, bias double, passes int, converged boolean"
    )
