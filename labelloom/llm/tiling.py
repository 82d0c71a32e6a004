"""Benchmark decontamination by greedy string tiling.

1. Seeds: every run of ``seed`` words of a benchmark item. The documents are scanned once per block of at most
   ``BLOCK_SEEDS`` seed hashes, which is what a task holds in memory; a benchmark of any size is a number of blocks.
   A document with a seed leaves its seeds and, packed, the hashes of its words.
2. Join: seeds found are joined with the benchmark's seeds. The item words that shared seeds cover bound what any
   tiling can reach, so pairs whose bound misses the threshold are dropped without loss.
3. Tiling: for each remaining pair the longest common stretch of unmarked words is marked, again and again, until
   none of ``seed`` words is left. Stretches are found with Karp-Rabin hashes that run over both sides, the length
   searched by bisection, and compared word by word before they are marked. Tiles may lie in any order, so reordered
   passages are found.

A document is contaminated by an item when tiles cover at least ``threshold`` of the item's words. Items shorter than
``seed`` words are one seed that must occur whole, anywhere in a document: documents are also hashed in windows of the
lengths of such items, of which there are at most ``seed`` - 1.

Defined cases: null and empty texts have no words and are never contaminated, and such items contaminate nothing;
equal items each get their pairs; documents that share an id are judged as one, rows without an id are left out; an empty table on either side gives no
pairs; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import shingles
from labelloom.session import ship_package, stage

SEED, THRESHOLD, BLOCK_SEEDS = 5, 0.5, 1_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def running_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows, by differences of prefix hashes (modulo 2**64)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    # Binary powering: windows of length 2**k are made of two halves, so a window takes log(size) steps.
    done, power, step, factor = 0, shingles.mix(words), 1, FACTOR
    while size:
        if size & 1:
            out = out * factor + power[done : done + n]
            done += step
        size >>= 1
        if size:
            power = power[: len(power) - step] * factor + power[step:]
            factor = np.uint64(int(factor) ** 2 & 0xFFFFFFFFFFFFFFFF)
            step *= 2
    return out


def _windows(free: np.ndarray, size: int) -> np.ndarray:
    """Whether the window at each place is free of marks."""
    total = np.concatenate([[0], np.cumsum(~free)])
    return total[size:] == total[: len(total) - size]


def _longest(item, doc, item_free, doc_free, least: int) -> tuple[int, int, int] | None:
    """``(length, item place, document place)`` of the longest common unmarked stretch, the first in the item."""

    def match(size: int):
        if size > min(len(item), len(doc)):
            return None
        a = np.flatnonzero(_windows(item_free, size))
        b = np.flatnonzero(_windows(doc_free, size))
        if not len(a) or not len(b):
            return None
        ha, hb = running_hashes(item, size)[a], running_hashes(doc, size)[b]
        order = np.argsort(hb, kind="stable")
        at = np.searchsorted(hb[order], ha)
        for k in np.flatnonzero(at < len(hb)).tolist():
            j = order[at[k]]
            if hb[j] == ha[k] and np.array_equal(item[a[k] : a[k] + size], doc[b[j] : b[j] + size]):
                return size, int(a[k]), int(b[j])
        return None

    best = match(least)
    if best is None:
        return None
    low, high = least, min(len(item), len(doc))
    while low < high:
        middle = (low + high + 1) // 2
        found = match(middle)
        if found:
            low, best = middle, found
        else:
            high = middle - 1
    return best


def tiles(item: np.ndarray, doc: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(length, item place, document place)``, longest first, none overlapping on a side."""
    item_free, doc_free = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool)
    least, out = min(least, max(len(item), 1)), []
    while found := _longest(item, doc, item_free, doc_free, least):
        size, a, b = found
        item_free[a : a + size] = False
        doc_free[b : b + size] = False
        out.append(found)
    return out


def item_seeds(benchmark: DataFrame, seed: int = SEED) -> DataFrame:
    """``(item_id, words, seeds, n_words)``: packed word hashes and the seed at each place."""
    ship_package(benchmark.sparkSession)

    def run(batches):
        from labelloom.llm import shingles as s

        for batch in batches:
            for at, texts in s.slices(batch.column("text")):
                words, bounds = s.word_hashes(texts)
                seeds, places = s.shingle_hashes(words, bounds, seed)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": batch.column("item_id").slice(at, len(texts)),
                        "item_words": pa.array([words[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                        "seeds": pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(seeds.view(np.int64))),
                        "n_words": pa.array(np.diff(bounds), pa.int32()),
                    }
                )

    rows = benchmark.select(F.col("item_id").cast("long"), "text")
    return rows.mapInArrow(run, "item_id long, item_words binary, seeds array<long>, n_words int")


def documents_with_seeds(
    docs: DataFrame, wanted: np.ndarray, seed: int = SEED, short: tuple[int, ...] = ()
) -> DataFrame:
    """``(doc_id, words, seeds)`` of the documents that hold any of the ``wanted`` seed hashes, those seeds distinct.
    ``short`` are the lengths of items of fewer words than a seed."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(np.sort(wanted.view(np.uint64)))  # at most BLOCK_SEEDS numbers

    def run(batches):
        from labelloom.llm import shingles as s

        known = shared.value
        coarse = np.zeros(1 << 24, dtype=bool)
        coarse[known >> np.uint64(40)] = True

        def known_only(seeds, places):
            hits = np.flatnonzero(coarse[seeds >> np.uint64(40)])
            spot = np.minimum(np.searchsorted(known, seeds[hits]), len(known) - 1)
            hits = hits[known[spot] == seeds[hits]]
            return seeds[hits], np.searchsorted(places, hits, side="right") - 1

        for batch in batches:
            for at, texts in s.slices(batch.column("text")):
                words, bounds = s.word_hashes(texts)
                seeds, places = s.shingle_hashes(words, bounds, seed)
                found = [known_only(seeds, places)]
                found += [known_only(*s.inner_windows(words, bounds, size)) for size in short]
                values, owner = (np.concatenate(parts) for parts in zip(*found))
                order = np.lexsort((values, owner))
                values, owner = values[order], owner[order]
                new = np.ones(len(values), dtype=bool)
                new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
                values, owner = values[new], owner[new]
                rows, starts = np.unique(owner, return_index=True)
                doc_ids = batch.column("doc_id").slice(at, len(texts)).take(pa.array(rows, pa.int64()))
                ends = pa.array(np.append(starts, len(values)), pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": doc_ids,
                        "doc_words": pa.array([words[bounds[r] : bounds[r + 1]].tobytes() for r in rows], pa.binary()),
                        "seeds": pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64))),
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, doc_words binary, seeds array<long>"
    )


def tile_pairs(pairs: DataFrame, seed: int, threshold: float) -> DataFrame:
    """``(doc_id, item_id, n_tiles, longest, covered, coverage)`` of contaminated pairs."""

    def run(batches):
        from labelloom.llm.tiling import tiles as tiles_here

        for batch in batches:
            rows = {"doc_id": [], "item_id": [], "n_tiles": [], "longest": [], "covered": [], "coverage": []}
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "item_id", "doc_words", "item_words")]
            for doc_id, item_id, doc, item in zip(*columns):
                item_words = np.frombuffer(item, np.uint64)
                found = tiles_here(item_words, np.frombuffer(doc, np.uint64), seed)
                covered = sum(t[0] for t in found)
                if found and covered >= threshold * len(item_words):
                    for name, value in zip(
                        rows, (doc_id, item_id, len(found), found[0][0], covered, covered / len(item_words))
                    ):
                        rows[name].append(value)
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.float64() if k == "coverage" else pa.int64()) for k, v in rows.items()}
            )

    return pairs.select("doc_id", "item_id", "doc_words", "item_words").mapInArrow(
        run, "doc_id long, item_id long, n_tiles long, longest long, covered long, coverage double"
    )


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, seed: int = SEED, threshold: float = THRESHOLD, block_seeds: int = BLOCK_SEEDS
) -> DataFrame:
    """``(doc_id, item_id, n_tiles, longest, covered, coverage)`` for every contaminated document and item."""
    spark = docs.sparkSession
    items = stage(item_seeds(benchmark, seed), "benchmark-items")
    placed = items.select("item_id", "n_words", F.posexplode("seeds").alias("pos", "seed"))
    hashes = placed.select("seed").distinct()
    blocks = -(-hashes.count() // block_seeds)
    lengths = items.where((F.col("n_words") > 0) & (F.col("n_words") < seed)).select("n_words").distinct()
    short = tuple(sorted(r.n_words for r in lengths.collect()))  # at most seed - 1 numbers
    found = None
    for block in range(blocks):
        part = hashes.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == block)
        wanted = part.toArrow().column("seed").to_numpy()  # a block: about block_seeds numbers
        if len(wanted):
            here = documents_with_seeds(docs, wanted, seed, short)
            found = here if found is None else found.union(here)
    if found is None:
        return spark.createDataFrame(
            [], "doc_id long, item_id long, n_tiles long, longest long, covered long, coverage double"
        )
    found = stage(found, "documents-with-seeds")
    # Words that shared seeds cover in the item: each seed covers `seed` places, overlaps once. A place counts by the
    # gap to the next shared seed, so a sum over neighbours gives the union.
    shared = found.select("doc_id", F.explode("seeds").alias("seed")).distinct().join(placed, "seed")
    covered = F.aggregate(
        F.array_sort(F.collect_set("pos")),
        F.struct(F.lit(-1_000_000).alias("end"), F.lit(0).alias("sum")),
        lambda a, p: F.struct(
            (p + F.lit(seed)).alias("end"), (a["sum"] + F.least(F.lit(seed), p + F.lit(seed) - a["end"])).alias("sum")
        ),
        lambda a: a["sum"],
    )
    reachable = (
        shared.groupBy("doc_id", "item_id")
        .agg(covered.alias("reach"), F.first("n_words").alias("n_words"))
        .where(F.least("reach", "n_words") >= F.col("n_words") * threshold)
        .select("doc_id", "item_id")
    )
    texts = found.select("doc_id", "doc_words").dropDuplicates(["doc_id", "doc_words"])
    pairs = reachable.join(texts, "doc_id").join(items.select("item_id", "item_words").distinct(), "item_id")
    tiled = tile_pairs(pairs, seed, threshold)
    return tiled.groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("n_tiles", "longest", "covered", "coverage"), F.struct("covered", "longest", "n_tiles")).alias("t")
    ).select("doc_id", "item_id", "t.*")
