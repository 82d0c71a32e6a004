"""Exact whole-number k-means over vectors whose dimension blocks are dictionary-encoded.

Every component x becomes ``floor(scale * x)``. A chunk of at most ``CHUNK_ROWS`` vectors is cut into blocks of
``BLOCK`` dimensions; each block keeps its distinct subvectors once, as a dictionary, and every vector a code per block.
Nothing is lost: dictionary and codes give the vector back. A round measures every distinct subvector of a chunk against
its block of all centroids once and a vector's distance to a centroid is the sum over its codes. New centroids need only
how often each code was assigned: counts times dictionary rows. Chunks are written once and read in every round.

What travels per round: the centroids (``k`` rows) to the tasks, and from each task one row of sums per centroid, added
up in Spark as decimals. A vector that is repeated any number of times is one dictionary entry per block of its chunk.

Start: the ``k`` kept vectors of smallest sha256 of ``1:<vec_id>``. Ties of distance go to the smaller centroid number;
a centroid is replaced by the exact floor of the mean of its vectors; empty ones stay. After ``rounds`` rounds vectors
are assigned once more.

Defined cases: vectors of another length, null vectors and vectors with null or non-finite components are not kept and
have no row. A kept vector with a component of absolute value above ``LIMIT`` (2 to the 27th after scaling, where
squared distances would not fit into a long) shapes nothing and has null cluster, distance, inertia and digest.
A null ``vec_id`` hashes as an empty one. Repeated rows are vectors of their own, also as starting centroids, ordered by their
components where hashes tie. With fewer than ``k`` vectors there are as many centroids as vectors; an empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import ship_package, stage

DIMS, K, ROUNDS, SCALE = 64, 16, 3, 64
BLOCK = 2
CHUNK_ROWS = 1 << 16
LIMIT = 1 << 27
ROWS_AT_ONCE = 1 << 13

CHUNKS = "ids binary, id_known binary, n int, dictionaries array<binary>, codes array<binary>"


@dataclass(frozen=True)
class Chunk:
    """Vectors of one row of the encoded table."""

    ids: np.ndarray
    known: np.ndarray
    dictionaries: list[np.ndarray]
    codes: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.ids)


def encode(vectors: np.ndarray, block: int = BLOCK) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct subvectors of every block of dimensions, and each vector's code in every block."""
    dictionaries, codes = [], []
    for at in range(0, vectors.shape[1], block):
        part = np.ascontiguousarray(vectors[:, at : at + block])
        whole = part.view([("", part.dtype)] * part.shape[1]).ravel()
        _, first, code = np.unique(whole, return_index=True, return_inverse=True)
        dictionaries.append(part[first])
        codes.append(code.astype(np.uint16 if len(first) <= 1 << 16 else np.uint32))
    return dictionaries, codes


def decode(dictionaries: list[np.ndarray], codes: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([d[c] for d, c in zip(dictionaries, codes)], axis=1)


def nearest(chunk: Chunk, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and its squared distance, for every vector of the chunk."""
    tables, at = [], 0
    for dictionary in chunk.dictionaries:
        width = dictionary.shape[1]
        apart = dictionary[:, None, :] - centroids[None, :, at : at + width]
        tables.append((apart * apart).sum(axis=2))
        at += width
    cluster = np.empty(len(chunk), dtype=np.int32)
    distance = np.empty(len(chunk), dtype=np.int64)
    for a in range(0, len(chunk), ROWS_AT_ONCE):
        b = min(a + ROWS_AT_ONCE, len(chunk))
        total = np.zeros((b - a, len(centroids)), dtype=np.int64)
        for table, codes in zip(tables, chunk.codes):
            total += table[codes[a:b]]
        cluster[a:b] = total.argmin(axis=1)
        distance[a:b] = total[np.arange(b - a), cluster[a:b]]
    return cluster, distance


def sums(chunk: Chunk, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors per centroid and the sums of their components, from counts of codes."""
    parts = []
    for dictionary, codes in zip(chunk.dictionaries, chunk.codes):
        n = len(dictionary)
        used = np.bincount(cluster.astype(np.int64) * n + codes, minlength=k * n).reshape(k, n)
        parts.append(used @ dictionary)
    return np.bincount(cluster, minlength=k), np.concatenate(parts, axis=1)


def to_row(ids: np.ndarray, known: np.ndarray, vectors: np.ndarray, block: int) -> dict:
    dictionaries, codes = encode(vectors, block)
    return {
        "ids": ids.astype("<i8").tobytes(),
        "id_known": known.astype(np.uint8).tobytes(),
        "n": len(ids),
        "dictionaries": [d.astype("<i4").tobytes() for d in dictionaries],
        "codes": [c.astype("<u4" if c.dtype == np.uint32 else "<u2").tobytes() for c in codes],
    }


def of_row(row: dict, dims: int, block: int) -> Chunk:
    n = row["n"]
    dictionaries, codes = [], []
    for i, (dictionary, code) in enumerate(zip(row["dictionaries"], row["codes"])):
        width = min(block, dims - i * block)
        dictionaries.append(np.frombuffer(dictionary, "<i4").reshape(-1, width).astype(np.int64))
        codes.append(np.frombuffer(code, "<u2" if len(code) == 2 * n else "<u4"))
    known = np.frombuffer(row["id_known"], np.uint8).astype(bool)
    return Chunk(np.frombuffer(row["ids"], "<i8"), known, dictionaries, codes)


def chunks_of(batches: Iterator[pa.RecordBatch], dims: int, block: int) -> Iterator[Chunk]:
    for batch in batches:
        for row in batch.to_pylist():
            yield of_row(row, dims, block)


def kept_vectors(embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v, fits)``: whole-number vectors, and whether distances between them fit into a long."""
    x = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(x, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    v = F.transform(x, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(2.0**62)), F.lit(-(2.0**62)))))
    kept = embeddings.where((F.size("embedding") == dims) & finite).select("vec_id", v.alias("v"))
    return kept.withColumn("fits", F.forall("v", lambda x: F.abs(x) <= LIMIT))


def encoded(vectors: DataFrame, dims: int, block: int, chunk_rows: int) -> DataFrame:
    """One row per chunk of ``vectors (vec_id, v)``."""

    def run(batches):
        from labelloom.llm import subvectors as s

        ids, known, rows, size = [], [], [], 0

        def chunk():
            return pa.RecordBatch.from_pylist(
                [s.to_row(np.concatenate(ids), np.concatenate(known), np.concatenate(rows), block)], schema=schema
            )

        schema = pa.schema(
            [
                ("ids", pa.binary()),
                ("id_known", pa.binary()),
                ("n", pa.int32()),
                ("dictionaries", pa.list_(pa.binary())),
                ("codes", pa.list_(pa.binary())),
            ]
        )
        for batch in batches:
            for at in range(0, len(batch), chunk_rows):
                part = batch.slice(at, chunk_rows)
                if size and size + len(part) > chunk_rows:
                    yield chunk()
                    ids, known, rows, size = [], [], [], 0
                ids.append(part.column(0).fill_null(0).to_numpy(zero_copy_only=False))
                known.append(part.column(0).is_valid().to_numpy(zero_copy_only=False))
                rows.append(part.column(1).flatten().to_numpy().astype(np.int32).reshape(len(part), dims))
                size += len(part)
        if size:
            yield chunk()

    ship_package(vectors.sparkSession)
    return vectors.select("vec_id", "v").mapInArrow(run, CHUNKS)


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors that come first in hash order."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([row.v for row in first], dtype=np.int64)


def totals(chunks: DataFrame, centroids: np.ndarray, dims: int, block: int) -> list:
    """``(cluster, n, sums)`` of every centroid that has vectors."""
    k = len(centroids)

    def run(batches):
        from labelloom.llm import subvectors as s

        n, total = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=object)
        for chunk in s.chunks_of(batches, dims, block):
            cluster, _ = s.nearest(chunk, centroids)
            count, part = s.sums(chunk, cluster, k)
            n += count
            total += part
        some = np.flatnonzero(n)
        if len(some):
            values = [[str(x) for x in total[i]] for i in some]
            yield pa.RecordBatch.from_pydict(
                {"cluster": pa.array(some, pa.int32()), "n": pa.array(n[some]), "total": pa.array(values, pa.list_(pa.string()))}
            )

    added = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    parts = chunks.mapInArrow(run, "cluster int, n long, total array<string>")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect()


def moved(centroids: np.ndarray, found: list, dims: int) -> np.ndarray:
    """Centroids after a round: the exact floors of the means; empty ones as they were."""
    after = centroids.copy()
    for row in found:
        after[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(dims)]
    return after


def assigned(chunks: DataFrame, centroids: np.ndarray, dims: int, block: int) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every encoded vector."""

    def run(batches):
        from labelloom.llm import subvectors as s

        for chunk in s.chunks_of(batches, dims, block):
            cluster, distance = s.nearest(chunk, centroids)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": pa.array(chunk.ids, mask=~chunk.known),
                    "cluster": pa.array(cluster),
                    "distance": pa.array(distance),
                }
            )

    return chunks.mapInArrow(run, "vec_id long, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(
    embeddings: DataFrame,
    *,
    k: int = K,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    block: int = BLOCK,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every kept vector of ``embeddings (vec_id, embedding)`` with its cluster; see the module."""
    spark = embeddings.sparkSession
    kept = kept_vectors(embeddings, dims, scale)
    vectors = kept.where("fits")
    chunks = stage(encoded(vectors, dims, block, chunk_rows), "subvectors")
    centroids = first_centroids(vectors, k)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(centroids, totals(chunks, centroids, dims, block), dims)
    else:
        centroids = np.zeros((1, dims), dtype=np.int64)
    found = stage(assigned(chunks, centroids, dims, block), "clusters")
    inertia = {r.cluster: int(r.inertia) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    whole = sum(inertia.values())
    fits = lambda x: x if x < 1 << 63 else None
    facts = spark.createDataFrame(
        [(c, fits(inertia.get(c, 0)), fits(whole), digest(centroids[c])) for c in range(len(centroids))],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # At most k rows.
    out = found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])
    beyond = kept.where("not fits").select("vec_id")
    for name, kind in out.dtypes[1:]:
        beyond = beyond.withColumn(name, F.lit(None).cast(kind))
    return out.unionByName(beyond)
