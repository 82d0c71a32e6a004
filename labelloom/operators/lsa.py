"""Dense text features: truncated SVD of hashed TF-IDF rows, and principal components of hashed counts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.text import explode_once
from labelloom.operators.features import BUCKETS
from labelloom.session import ship_package

# Components of the truncated SVD and of the principal component analysis.
COMPONENTS = 256
PRINCIPAL = 40
# Documents that are multiplied at once: their dense rows of 4096 buckets are 8 MB.
CHUNK = 256


@dataclass(frozen=True)
class LsaBasis:
    """Bucket weights, right singular vectors (buckets x k) and singular values: of fixed size whatever the corpus.

    ``center`` is what is taken off a row's projection, and ``unit`` whether rows are brought to unit length first.
    """

    idf: np.ndarray
    vectors: np.ndarray
    singular_values: np.ndarray
    center: np.ndarray | None = None
    unit: bool = True


def bucket_idf(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``ln((1 + n) / (1 + df)) + 1`` of every bucket over the rows ``(id, buckets, counts)``."""
    frequency = np.zeros(buckets)
    used = explode_once(rows.select("buckets"), "buckets", "bucket").groupBy("bucket").agg(F.count("*").alias("df"))
    for row in used.collect():
        frequency[row["bucket"]] = row["df"]
    return np.log((1 + rows.count()) / (1 + frequency)) + 1


def _dense(batch: pa.RecordBatch, idf: np.ndarray, unit: bool = True):
    """Ids and weighed rows (documents x buckets) of a batch, ``CHUNK`` documents at a time; with ``unit``, rows have
    unit length. A product of dense rows is one call of BLAS, whose working set does not grow with the batch."""
    buckets = len(idf)
    for at in range(0, batch.num_rows, CHUNK):
        part = batch.slice(at, CHUNK)
        bucket = part.column("buckets").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        count = part.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        local = np.repeat(np.arange(part.num_rows), part.column("buckets").value_lengths().to_numpy(zero_copy_only=False))
        weights = count * idf[bucket]
        if unit:
            weights = weights / np.sqrt(np.bincount(local, weights * weights, minlength=part.num_rows))[local]
        cells = np.bincount(local * buckets + bucket, weights, minlength=part.num_rows * buckets)
        yield part.column("id"), cells.reshape(part.num_rows, buckets)


def _gram_times(rows: DataFrame, idf: np.ndarray, matrix: np.ndarray, unit: bool = True) -> np.ndarray:
    """``(X'X) matrix`` in one pass: partitions add up their documents, one group per bucket adds up partitions."""
    ship_package(rows.sparkSession)
    shape = matrix.shape
    names = [f"c{j}" for j in range(shape[1])]
    shared = rows.sparkSession.sparkContext.broadcast((idf, matrix))

    def partial(batches):
        idf, matrix = shared.value
        total = np.zeros(shape)
        for batch in batches:
            for _, dense in _dense(batch, idf, unit):
                total += dense.T @ (dense @ matrix)
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        columns = [pa.array(total[used, j]) for j in range(shape[1])]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(used, pa.int64())], names=[*names, "bucket"])

    parts = rows.mapInArrow(partial, ", ".join(f"{c} double" for c in names) + ", bucket long")
    summed = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
    result = np.zeros(shape)
    result[summed["bucket"].to_numpy()] = summed[names].to_numpy()
    return result


def fit_lsa(rows: DataFrame, k: int = COMPONENTS, buckets: int = BUCKETS, passes: int = 3, seed: int = 0) -> LsaBasis:
    """Randomised truncated SVD of the uncentred, unit-length TF-IDF rows of ``(id, buckets, counts)``.

    Subspace iteration reads the stored rows ``passes + 1`` times. The driver only holds ``buckets x (k + 10)``
    numbers.
    """
    idf = bucket_idf(rows, buckets)
    width = min(k + 10, buckets)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((buckets, width)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(_gram_times(rows, idf, basis))[0]
    values, rotation = np.linalg.eigh(basis.T @ _gram_times(rows, idf, basis))
    order = np.argsort(values)[::-1][:k]
    return LsaBasis(idf, basis @ rotation[:, order], np.sqrt(np.clip(values[order], 0, None)))


def project(rows: DataFrame, basis: LsaBasis) -> DataFrame:
    """``(id, features)`` as arrays, weighed as the documents the basis was fitted on; every row stays."""
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(basis)

    def rotate(batches):
        basis = shared.value
        for batch in batches:
            for ids, dense in _dense(batch, basis.idf, basis.unit):
                features = dense @ basis.vectors
                if basis.center is not None:
                    features = features - basis.center
                bounds = np.arange(len(features) + 1, dtype=np.int32) * features.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(features.ravel()))
                yield pa.RecordBatch.from_arrays([ids, lists], names=["id", "features"])

    return rows.mapInArrow(rotate, "id long, features array<double>")


# Rows of a stored basis that belong to no bucket.
VALUES, CENTER = -1, -2


def basis_table(spark: SparkSession, basis: LsaBasis) -> DataFrame:
    """``(bucket, idf, vector)`` to be stored: a row per bucket, one with the singular values and whether rows are
    brought to unit length, and one with the center if there is one."""
    lines = [(i, float(w), v.tolist()) for i, (w, v) in enumerate(zip(basis.idf, basis.vectors))]
    lines.append((VALUES, float(basis.unit), np.asarray(basis.singular_values).tolist()))
    if basis.center is not None:
        lines.append((CENTER, 0.0, basis.center.tolist()))
    return spark.createDataFrame(lines, "bucket long, idf double, vector array<double>")


def load_basis(table: DataFrame) -> LsaBasis:
    lines = {r["bucket"]: r for r in table.collect()}
    values, center = lines.pop(VALUES), lines.pop(CENTER, None)
    rows = [lines[i] for i in range(len(lines))]
    return LsaBasis(
        np.array([r["idf"] for r in rows]),
        np.array([r["vector"] for r in rows]),
        np.array(values["vector"]),
        center=np.array(center["vector"]) if center else None,
        unit=values["idf"] > 0,
    )


def basis_checks(features: DataFrame, basis: LsaBasis) -> DataFrame:
    """One row about the projected rows that a basis was fitted on: documents, components, and whether vectors are
    orthonormal, values fall, and the rows' squares (variances, with a center) along each component are the values'."""
    k = basis.vectors.shape[1]
    orthonormal = np.abs(basis.vectors.T @ basis.vectors - np.eye(k)).max() < 1e-8
    falling = (np.diff(basis.singular_values) <= 1e-9).all()
    entries = features.select("id", F.posexplode("features").alias("place", "x"))
    squares = F.sum(F.col("x") * F.col("x")) if basis.center is None else F.var_samp("x")
    found = entries.groupBy("place").agg(squares.alias("square"), F.avg("x").alias("mean")).collect()  # a row per component
    kept = all(abs(r["square"] - basis.singular_values[r["place"]] ** 2) <= 1e-6 * basis.singular_values[0] ** 2 for r in found)
    middle = basis.center is None or all(abs(r["mean"]) <= 1e-6 * basis.singular_values[0] for r in found)
    flag = lambda x: F.lit(int(bool(x)))
    return features.agg(F.count("*").alias("documents")).select(
        "documents",
        F.lit(k).cast("long").alias("components"),
        flag(orthonormal).alias("orthonormal"),
        flag(falling).alias("falling"),
        flag(kept and middle).alias("squares_kept"),
    )


def fit_pca(rows: DataFrame, k: int = PRINCIPAL, buckets: int = BUCKETS, passes: int = 3, seed: int = 0) -> LsaBasis:
    """Principal components of the hashed counts ``(id, buckets, counts)``, by the same subspace iteration.

    Rows are never centred: the mean is taken off the products, which keeps them sparse. ``singular_values`` are
    standard deviations along the components.
    """
    n, mean = rows.count(), np.zeros(buckets)
    entries = explode_once(
        rows.select(F.arrays_zip("buckets", "counts").alias("entries")), "entries", "entry"
    ).select(F.col("entry.buckets").alias("bucket"), F.col("entry.counts").alias("tf"))
    for row in entries.groupBy("bucket").agg(F.sum("tf").alias("tf")).collect():  # at most one row per bucket
        mean[row["bucket"]] = row["tf"] / max(n, 1)
    plain, width = np.ones(buckets), min(k + 10, buckets)

    def centred(matrix: np.ndarray) -> np.ndarray:
        return _gram_times(rows, plain, matrix, unit=False) - n * np.outer(mean, mean @ matrix)

    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((buckets, width)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(centred(basis))[0]
    values, rotation = np.linalg.eigh(basis.T @ centred(basis))
    order = np.argsort(values)[::-1][:k]
    vectors = basis @ rotation[:, order]
    spread = np.sqrt(np.clip(values[order], 0, None) / max(n - 1, 1))
    return LsaBasis(plain, vectors, spread, center=mean @ vectors, unit=False)
