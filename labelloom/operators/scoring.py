"""Score documents against the linear models of all tags.

A model is a bias and a weight per term. Models are cut into blocks of tags of at most ``BLOCK_ROWS`` weights, which is
what a task holds in memory: any number of tags is a number of blocks. Documents are scored where they lie, a batch
against one block after the other, and only tags that accept a document are put out. Nothing is shuffled with one
block; with more of them, accepted tags are brought together by document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.session import ship_package, stage

BLOCK_ROWS = 2_000_000
CELLS = 4_000_000
# Weights that a task looks up at once: documents are taken in slices that have no more, or one by one.
ENTRIES = 500_000


class ModelBlock:
    """Weights of a block of tags, grouped by term."""

    def __init__(self, weights, biases) -> None:
        self.tags = biases["tag"].to_numpy()
        self.bias = biases["bias"].to_numpy(dtype=np.float64)
        codes, terms = weights["term"].factorize(sort=False)
        order = np.argsort(codes, kind="stable")
        column = {t: i for i, t in enumerate(self.tags)}
        self.term = {t: i for i, t in enumerate(terms)}
        self.column = weights["tag"].map(column).to_numpy()[order]
        self.weight = weights["weight"].to_numpy(dtype=np.float64)[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(terms)))]).astype(np.int64)
        self.most = int(np.diff(self.start).max(initial=1))

    def slices(self, terms: pa.Array):
        """``(start, length)`` of slices of at most ``ENTRIES`` weights and ``CELLS`` scores, or of one document."""
        entries = np.cumsum(terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) * self.most
        step, at, before = max(1, CELLS // max(len(self.tags), 1)), 0, 0
        while at < len(terms):
            end = max(at + 1, min(at + step, int(np.searchsorted(entries, before + ENTRIES, side="right"))))
            yield at, end - at
            at, before = end, entries[end - 1]

    def scores(self, terms: pa.Array, binary: bool) -> np.ndarray:
        """``(documents, tags)`` of a list array of terms."""
        coded = terms.flatten().dictionary_encode()
        place = np.array([self.term.get(t, -1) for t in coded.dictionary.to_pylist()], dtype=np.int64)
        rows = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))
        found = place[coded.indices.to_numpy()] if len(place) else np.empty(0, np.int64)
        rows, found = rows[found >= 0], found[found >= 0]
        pairs, counts = np.unique(rows * max(len(self.start), 1) + found, return_counts=True)
        rows, found = pairs // max(len(self.start), 1), pairs % max(len(self.start), 1)
        n = self.start[found + 1] - self.start[found]
        ends = np.cumsum(n)
        entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[found] - ends + n, n)
        amount = self.weight[entry] * (1 if binary else np.repeat(counts, n))
        cells = np.repeat(rows, n) * len(self.tags) + self.column[entry]
        total = np.bincount(cells, amount, minlength=len(terms) * len(self.tags))
        return total.reshape(len(terms), len(self.tags)) + self.bias


def model_blocks(models: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(tag, bias, block)``: tags in order, cut whenever another ``block_rows`` weights are full."""
    sizes = models.groupBy("tag").agg(F.max("bias").alias("bias"), F.count("*").alias("n"))
    filled = F.sum("n").over(Window.orderBy("tag").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    return sizes.withColumn("block", F.floor(filled / block_rows)).select("tag", "bias", "block")


def _accepted(documents: DataFrame, block: ModelBlock, binary: bool) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_ROWS weights and one more tag

    def run(batches):
        block = shared.value
        for batch in batches:
            for at, length in block.slices(batch.column("terms")):
                part = batch.slice(at, length)
                positive = block.scores(part.column("terms"), binary) > 0
                bounds = np.concatenate([[0], np.cumsum(positive.sum(axis=1))])
                tags = pa.array(block.tags[np.nonzero(positive)[1]], pa.string())
                yield pa.RecordBatch.from_pydict(
                    {"id": part.column("id"), "tags": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), tags)}
                )

    return documents.select("id", "terms").mapInArrow(run, "id long, tags array<string>")


def suggest_tags(documents: DataFrame, models: DataFrame, binary: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(id, tags)`` for every document: the tags whose bias plus term weights is positive, sorted.

    ``documents``: ``(id, terms)``; ``models``: ``(tag, term, weight, bias)``. ``binary`` counts a term once. A
    document that no model accepts has an empty answer.
    """
    spark = documents.sparkSession
    ship_package(spark)
    placed = stage(model_blocks(models, block_rows), "model-blocks")
    blocks = [r["block"] for r in placed.select("block").distinct().orderBy("block").collect()]
    if not blocks:
        return documents.select("id", F.array().cast("array<string>").alias("tags"))
    answers = None
    for number in blocks:
        here = placed.where(F.col("block") == number)
        weights = models.join(here.select("tag"), "tag", "left_semi").where("term <> ''").select("tag", "term", "weight")
        block = ModelBlock(weights.toPandas(), here.orderBy("tag").toPandas())
        found = _accepted(documents, block, binary)
        answers = found if answers is None else answers.unionByName(found)
    if len(blocks) == 1:
        return answers
    return answers.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("tags"))).alias("tags"))
