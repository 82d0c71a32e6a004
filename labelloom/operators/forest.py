"""Random forests of all tags, parameters and folds, grown level by level.

Features are bins. A (tag, parameters, fold) is a job of as many trees as the largest forest has; smaller forests are its
first trees. A level is one pass: rows find their nodes in the task, and their bootstrap weights are added up per open
node, candidate feature, bin and label; these histograms are summed per job and every open node takes its best split.
Bootstrap weights and candidate features are whole-number hashes of (row, tree) and (tree, node, feature), so any engine
can restate them.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators import passes

# The searched grid. A split needs two rows at least, so a minimum of 1 and 2 are the same setting.
TREES = (10, 20, 30)
IMPURITIES = ("gini", "entropy")
SUBSETS = ("sqrt", "log2")
MIN_SPLIT = (2, 3)
MAX_DEPTH = 30

BINS = 32
PRIME = 2**31 - 1
# Distribution of a Poisson number of mean 1, as places on the circle of hashes.
POISSON = tuple(int(PRIME * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(8))


def mixed(x):
    """Whole numbers below ``PRIME`` without visible pattern, of whole numbers from 0."""
    x = x % PRIME
    y = (x * x + 48271) % PRIME
    y = (y * y + x) % PRIME
    return (y * 69621) % PRIME


def bootstrap(ids: np.ndarray, trees: int) -> np.ndarray:
    """How often each tree takes each row, ``(rows, trees)``."""
    place = mixed(ids.astype(np.int64) % PRIME)[:, None] * 31 + np.arange(1, trees + 1)[None, :] * 1000003
    return np.searchsorted(np.array(POISSON), mixed(place), side="right")


def candidates(tree: np.ndarray, node: np.ndarray, dims: int, k: int) -> np.ndarray:
    """The ``k`` features each node may split on, in ascending order."""
    start = mixed(tree.astype(np.int64) * 1000003 + node.astype(np.int64) * 7919 + 1)
    order = mixed(start[:, None] + np.arange(dims)[None, :] * 104729)
    return np.sort(np.argsort(order, axis=1, kind="stable")[:, :k], axis=1)


def subset_size(subset: str, dims: int) -> int:
    return max(1, int(math.sqrt(dims) if subset == "sqrt" else math.log2(dims)))


@dataclass
class Forest:
    """Nodes of all trees of a job, the roots first; a child's number follows its sibling's."""

    fold: int
    impurity: str
    subset: str
    min_split: int
    trees: int
    dims: int
    tree: np.ndarray
    node: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    share: np.ndarray
    open: np.ndarray

    @property
    def k(self) -> int:
        return subset_size(self.subset, self.dims)

    def accepts(self, x: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Rows that the trees find positive on average."""
        return shares(self, bins).mean(axis=1) > 0.5


def planted(row: dict) -> Forest:
    n = row["trees"]
    return Forest(
        row["fold"],
        row["impurity"],
        row["subset"],
        row["min_split"],
        n,
        row["dims"],
        tree=np.arange(n, dtype=np.int32),
        node=np.ones(n, dtype=np.int64),
        feature=np.full(n, -1, dtype=np.int32),
        bin=np.zeros(n, dtype=np.uint8),
        left=np.zeros(n, dtype=np.int32),
        share=np.zeros(n),
        open=np.ones(n, dtype=bool),
    )


def leaves(forest: Forest, x: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Nodes that rows end in, from the nodes ``at``."""
    at = at.copy()
    moving = np.flatnonzero(forest.feature[at] >= 0)
    while len(moving):
        here = at[moving]
        right = x[row[moving], forest.feature[here]] > forest.bin[here]
        at[moving] = forest.left[here] + right
        moving = moving[forest.feature[at[moving]] >= 0]
    return at


def _added_up(codes: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(codes, return_inverse=True)
    return found, np.bincount(place, amounts, len(found)).astype(np.int64)


def measure(block: passes.Block, forest: Forest):
    """Histogram entries of a training block, and rows, of every open node."""
    if block.fold == forest.fold:
        return None
    times = bootstrap(block.ids, forest.trees)
    row, tree = np.nonzero(times)
    at = leaves(forest, block.x, row, tree)
    kept = forest.open[at]
    row, tree, at = row[kept], tree[kept], at[kept]
    nodes = np.flatnonzero(forest.open)
    slot = np.searchsorted(nodes, at)
    features = candidates(forest.tree[nodes], forest.node[nodes], forest.dims, forest.k)
    values = block.x[row[:, None], features[slot]].astype(np.int64)
    cell = (slot[:, None] * forest.k + np.arange(forest.k)) * BINS + values
    codes = cell * 2 + block.label[row][:, None]
    amounts = np.broadcast_to(times[row, tree][:, None], codes.shape)
    return *_added_up(codes.ravel(), amounts.ravel()), np.bincount(slot, minlength=len(nodes))


def add(one, two):
    codes, amounts = _added_up(np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]]))
    return codes, amounts, one[2] + two[2]


def gain(left: np.ndarray, right: np.ndarray, impurity: str) -> np.ndarray:
    """What to maximise over the splits of a node, from label counts on both sides; rounded, so that equals are equal."""
    if impurity == "gini":
        value = sum((side * side).sum(axis=-1) / np.maximum(side.sum(axis=-1), 1) for side in (left, right))
    else:
        xlog = lambda v: v * np.log(np.maximum(v, 1))
        value = sum(xlog(side).sum(axis=-1) - xlog(side.sum(axis=-1)) for side in (left, right))
    return np.round(value, 6)


def step(forest: Forest, part, max_depth: int = MAX_DEPTH) -> tuple[Forest, bool]:
    """Split every open node; impure children are open."""
    nodes = np.flatnonzero(forest.open)
    forest.open[:] = False
    if part is None:
        return forest, False
    codes, amounts, rows = part
    m, k = len(nodes), forest.k
    counts = np.zeros(m * k * BINS * 2)
    counts[codes] = amounts
    counts = counts.reshape(m, k, BINS, 2)
    total = counts[:, 0].sum(axis=1)
    forest.share[nodes] = total[:, 1] / np.maximum(total.sum(axis=1), 1)
    left = counts.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None, :] - left
    value = gain(left, right, forest.impurity)
    value[(left.sum(axis=-1) == 0) | (right.sum(axis=-1) == 0)] = -np.inf
    best = value.reshape(m, -1).argmax(axis=1)
    possible = value.reshape(m, -1)[np.arange(m), best] > -np.inf
    depth = np.floor(np.log2(forest.node[nodes])).astype(int)
    split = possible & (total.min(axis=1) > 0) & (rows >= forest.min_split) & (depth < max_depth)
    which = np.flatnonzero(split)
    parents, place, cut = nodes[which], best[which] // (BINS - 1), best[which] % (BINS - 1)
    features = candidates(forest.tree[parents], forest.node[parents], forest.dims, k) if len(which) else np.empty((0, k), int)
    first = len(forest.feature) + 2 * np.arange(len(which))
    forest.feature[parents] = features[np.arange(len(which)), place]
    forest.bin[parents] = cut
    forest.left[parents] = first
    sides = np.stack([left[which, place, cut], right[which, place, cut]], axis=1).reshape(-1, 2)
    n = len(sides)
    forest.tree = np.concatenate([forest.tree, np.repeat(forest.tree[parents], 2)])
    forest.node = np.concatenate([forest.node, np.repeat(forest.node[parents] * 2, 2) + np.tile([0, 1], len(which))])
    forest.feature = np.concatenate([forest.feature, np.full(n, -1, dtype=np.int32)])
    forest.bin = np.concatenate([forest.bin, np.zeros(n, dtype=np.uint8)])
    forest.left = np.concatenate([forest.left, np.zeros(n, dtype=np.int32)])
    forest.share = np.concatenate([forest.share, sides[:, 1] / np.maximum(sides.sum(axis=1), 1)])
    below = np.repeat(depth[which], 2) + 1 < max_depth
    forest.open = np.concatenate([forest.open, (sides.min(axis=1) > 0) & below])
    return forest, bool(forest.open.any())


def grid(
    tags: DataFrame,
    folds: int,
    dims: int,
    trees: int = max(TREES),
    impurities: Sequence[str] = IMPURITIES,
    subsets: Sequence[str] = SUBSETS,
    min_split: Sequence[int] = MIN_SPLIT,
) -> DataFrame:
    """A job per tag, fold and setting."""
    every = lambda values: F.explode(F.array(*[F.lit(v) for v in values]))
    jobs = tags.select("tag", every(range(folds)).alias("fold"))
    for name, values in (("impurity", impurities), ("subset", subsets), ("min_split", min_split)):
        jobs = jobs.select("*", every(values).alias(name))
    return jobs.withColumn("trees", F.lit(trees)).withColumn("dims", F.lit(dims))


def fit(blocks: DataFrame, jobs: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """States of ``jobs (tag, fold, impurity, subset, min_split, trees, dims)`` on blocks of bins; fold -1 leaves none out."""
    named = jobs.withColumn("job", F.concat_ws(":", "impurity", "subset", "min_split", "trees", "fold"))
    first = passes.states(named.select("tag", "job", *(c for c in jobs.columns if c != "tag")), planted)
    grow = lambda state, part: step(state, part, max_depth)
    return passes.fitted(
        blocks, first, measure, add, grow, max_depth, weight=lambda p: sum(a.nbytes for a in p), name="forest"
    )


def shares(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Share of positive rows in the leaf of every row and tree."""
    row = np.repeat(np.arange(len(x)), forest.trees)
    tree = np.tile(np.arange(forest.trees), len(x))
    return forest.share[leaves(forest, x, row, tree)].reshape(len(x), forest.trees)


def _hits(tag: str, block: passes.Block, forest: Forest, sizes: Sequence[int]) -> list[tuple]:
    if block.fold != forest.fold:
        return []
    share = shares(forest, block.x).cumsum(axis=1)
    out = []
    for n in sizes:
        positive = share[:, n - 1] / n > 0.5
        setting = (forest.impurity, forest.subset, forest.min_split, n)
        counts = (len(positive), int(block.label.sum()), int((positive & block.label).sum()), int(positive.sum()))
        out.append((tag, forest.fold, *setting, *counts))
    return out


def fold_scores(blocks: DataFrame, found: DataFrame, sizes: Sequence[int] = TREES) -> DataFrame:
    """``(tag, model, impurity, subset, min_split, trees, fold, n, positives, hits, predicted, f1)`` on left-out folds."""
    schema = (
        "tag string, fold int, impurity string, subset string, min_split int, trees int, "
        "n long, positives long, hits long, predicted long"
    )
    keys = ("tag", "impurity", "subset", "min_split", "trees", "fold")
    rows = passes.scored(blocks, found, lambda tag, block, state: _hits(tag, block, state, sizes), schema)
    sums = rows.groupBy(*keys).agg(*(F.sum(x).alias(x) for x in ("n", "positives", "hits", "predicted")))
    both = F.col("positives") + F.col("predicted")
    f1 = F.when(both > 0, 2 * F.col("hits") / both).otherwise(0.0)
    return sums.select("*", F.lit("random_forest").alias("model"), f1.alias("f1"))


def root_splits(found: DataFrame) -> DataFrame:
    """``(tag, fold, impurity, subset, min_split, tree, feature, bin)`` of every tree; -1 where the root is a leaf."""
    schema = "tag string, fold int, impurity string, subset string, min_split int, tree int, feature int, bin int"

    def run(batches):
        for batch in batches:
            for tag, blob in zip(batch.column("tag").to_pylist(), batch.column("state").to_pylist()):
                s = pickle.loads(blob)
                n = s.trees
                same = lambda v, kind: pa.array([v] * n, kind)
                leaf = s.feature[:n] < 0
                yield pa.RecordBatch.from_pydict(
                    {
                        "tag": same(tag, pa.string()),
                        "fold": same(s.fold, pa.int32()),
                        "impurity": same(s.impurity, pa.string()),
                        "subset": same(s.subset, pa.string()),
                        "min_split": same(s.min_split, pa.int32()),
                        "tree": pa.array(np.arange(n), pa.int32()),
                        "feature": pa.array(s.feature[:n], pa.int32()),
                        "bin": pa.array(np.where(leaf, -1, s.bin[:n]), pa.int32()),
                    }
                )

    return found.select("tag", "state").mapInArrow(run, schema)


def bin_edges(features: DataFrame, bins: int = BINS, accuracy: int = 1000) -> np.ndarray:
    """Quantiles of every place of ``(features ARRAY<DOUBLE>)``: a table of fixed size, on the driver."""
    entries = features.select(F.posexplode("features").alias("place", "value"))
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    rows = entries.groupBy("place").agg(F.percentile_approx("value", at, F.lit(accuracy)).alias("edges")).collect()
    return np.array([row.edges for row in sorted(rows)])


def binned(features: DataFrame, edges: np.ndarray, name: str = "features") -> DataFrame:
    """The rows with, as ``name``, the number of edges below each of the ``features``."""
    others = [c for c in features.columns if c != name]
    at = features.columns.index("features")

    def run(batches):
        for batch in batches:
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in others} | {name: pa.array(list(bins), pa.list_(pa.int32()))})

    schema = ", ".join(f"`{c}` {t}" for c, t in features.dtypes if c != name)
    return features.mapInArrow(run, f"{schema}, {name} array<int>")


def dense_counts(rows: DataFrame, buckets: int, bins: int = BINS) -> DataFrame:
    """``(id, features)``: the hashed counts ``(id, buckets, counts)`` of every text as bins, high counts in the last."""

    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.column("buckets").offsets.to_numpy())
            x = np.zeros((len(batch), buckets), dtype=np.int32)
            counts = np.minimum(batch.column("counts").flatten().to_numpy(), bins - 1)
            x[np.repeat(np.arange(len(batch)), sizes), batch.column("buckets").flatten().to_numpy()] = counts
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "features": pa.array(list(x), pa.list_(pa.int32()))})

    return rows.select("id", "buckets", "counts").mapInArrow(run, "id long, features array<int>")
