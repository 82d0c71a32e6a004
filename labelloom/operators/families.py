"""The choice between all trained families per tag, and scoring documents with the chosen models.

Every family is scored on the same stored blocks and folds; the best mean wins, ties go to the earlier family and then
to the earlier grid point. Winners are fitted anew on all rows and stored as ``(tag, model, state)``. To score documents, models
are packed into files of at most ``FILE_BYTES`` and every group of documents meets every file once; neither models nor
documents pass through the driver, and no plan grows with the number of models.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.operators import boosting, evaluate, forest, passes, signs, svm
from labelloom.session import ship_package, stage

FILE_BYTES = 16_000_000
GROUP_ROWS = 20_000
PARAMS = {"alpha": "double", "c": "double", "impurity": "string", "subset": "string", "min_split": "int", "trees": "int"}
COUNTS = ("n", "positives", "hits", "predicted")


@dataclass(frozen=True)
class Grids:
    """What is searched; the defaults are the whole grids."""

    alphas: Sequence[float] = signs.ALPHAS
    c_values: Sequence[float] = svm.C_VALUES
    forest_trees: Sequence[int] = forest.TREES
    impurities: Sequence[str] = forest.IMPURITIES
    subsets: Sequence[str] = forest.SUBSETS
    min_split: Sequence[int] = forest.MIN_SPLIT
    boosted_trees: Sequence[int] = boosting.TREES
    families: Sequence[str] = ("bernoulli_nb", "linear_svc", "random_forest", "gradient_boosting")

    @property
    def points(self) -> int:
        several = len(self.subsets) * len(self.min_split)
        sizes = {
            "bernoulli_nb": len(self.alphas),
            "linear_svc": len(self.c_values),
            "random_forest": len(self.forest_trees) * len(self.impurities) * several,
            "gradient_boosting": len(self.boosted_trees) * several,
        }
        return sum(sizes[f] for f in self.families)


def fold_scores(blocks: DataFrame, bins: DataFrame, dims: int, folds: int, grids: Grids = Grids()) -> DataFrame:
    """``(tag, model, parameters, fold, n, positives, hits, predicted, f1)`` of every family and grid point; staged."""
    tags = blocks.select("tag").distinct()
    found = []
    if "bernoulli_nb" in grids.families:
        found.append(signs.fold_scores(blocks, signs.fit(blocks, tags, folds, dims), grids.alphas))
    if "linear_svc" in grids.families:
        found.append(svm.fold_scores(blocks, svm.fit(blocks, svm.grid(tags, folds, grids.c_values), dims)))
    if "random_forest" in grids.families:
        jobs = forest.grid(tags, folds, dims, max(grids.forest_trees), grids.impurities, grids.subsets, grids.min_split)
        found.append(forest.fold_scores(bins, forest.fit(bins, jobs), tuple(grids.forest_trees)))
    if "gradient_boosting" in grids.families:
        jobs = boosting.grid(tags, folds, grids.subsets, grids.min_split)
        states = stage(boosting.fit(bins, jobs, max(grids.boosted_trees)), "boosted")
        found.append(boosting.fold_scores(bins, states, tuple(grids.boosted_trees)))

    def level(scores):
        given = [F.col(p).cast(t).alias(p) if p in scores.columns else F.lit(None).cast(t).alias(p) for p, t in PARAMS.items()]
        return scores.select("tag", "model", *given, "fold", *COUNTS, "f1")

    whole = level(found[0])
    for scores in found[1:]:
        whole = whole.unionByName(level(scores))
    return stage(whole, "family-scores")


def report(scores: DataFrame) -> DataFrame:
    """Mean and twice the deviation over the folds of every grid point."""
    return evaluate.score_report(scores, *PARAMS)


def best_of_families(means: DataFrame) -> DataFrame:
    """The best grid point of every (tag, model); ties go to the first in the order of the grids."""
    place = lambda name, values: F.array_position(F.array(*[F.lit(v) for v in values]), F.col(name))
    order = (
        place("impurity", forest.IMPURITIES), place("subset", forest.SUBSETS), "min_split", "trees", "alpha", "c"
    )
    rank = F.row_number().over(Window.partitionBy("tag", "model").orderBy(F.round("mean_f1", 12).desc(), *order))
    return means.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def winners(means: DataFrame) -> DataFrame:
    """One model per tag over all families."""
    return evaluate.best_model(best_of_families(means))


def refit(chosen: DataFrame, blocks: DataFrame, bins: DataFrame, dims: int, folds: int) -> DataFrame:
    """``(tag, model, state)``: the chosen grid points ``(tag, model, parameters)`` fitted on all rows."""
    none = F.lit(svm.NO_FOLD).alias("fold")
    of = lambda model: chosen.where(F.col("model") == model)
    costs = of("linear_svc").select("tag", none, F.array("c").alias("c_values"))
    trees = of("random_forest").select("tag", none, "impurity", "subset", "min_split", "trees", F.lit(dims).alias("dims"))
    boosted = of("gradient_boosting").select("tag", none, "subset", "min_split", "trees")
    parts = {
        "bernoulli_nb": signs.fit(blocks, of("bernoulli_nb").select("tag", "alpha"), folds, dims),
        "linear_svc": svm.fit(blocks, costs, dims),
        "random_forest": forest.fit(bins, trees),
        "gradient_boosting": boosting.fit(bins, boosted),
    }
    whole = None
    for model, states in parts.items():
        part = states.select("tag", F.lit(model).alias("model"), "state")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def model_files(models: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``(file, tag, model, state)``: tags in order, a new file whenever ``file_bytes`` are full."""
    sizes = models.select("tag", F.octet_length("state").cast("long").alias("bytes"))
    filled = F.sum("bytes").over(Window.orderBy("tag").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    return models.join(sizes.select("tag", F.floor(filled / file_bytes).alias("file")), "tag")


def suggest(documents: DataFrame, models: DataFrame, file_bytes: int = FILE_BYTES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(id, tags)`` of ``documents (id, features, bins)``: the sorted tags whose ``models (tag, model, state)`` accept."""
    files = stage(model_files(models, file_bytes), "model-files")
    count = files.agg(F.max("file")).first()[0]
    if count is None:
        return documents.select("id", F.array().cast("array<string>").alias("tags"))
    groups = max(1, math.ceil(documents.count() / group_rows))
    ship_package(documents.sparkSession)
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count).cast("long")))
    left = documents.select("id", "features", "bins", group.alias("group"), every.alias("file"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    right = files.select("*", copies)

    def run(docs, held):
        n = len(docs)
        if not n:
            return pa.table({"id": pa.array([], pa.int64()), "tags": pa.array([], pa.list_(pa.string()))})
        x, bins = (docs.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in ("features", "bins"))
        tags = sorted(held.column("tag").to_pylist())
        state = dict(zip(held.column("tag").to_pylist(), held.column("state").to_pylist()))
        accepted = np.array([pickle.loads(state[t]).accepts(x, bins) for t in tags]).reshape(len(tags), n).T
        bounds = np.concatenate([[0], np.cumsum(accepted.sum(axis=1))])
        found = pa.array([tags[i] for i in np.nonzero(accepted)[1]], pa.string())
        return pa.table({"id": docs.column("id"), "tags": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found)})

    keys = ("file", "group")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "id long, tags array<string>")
    if count == 0:
        return found
    return found.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("tags"))).alias("tags"))
