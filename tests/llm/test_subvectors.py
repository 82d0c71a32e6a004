"""Exact k-means over encoded subvectors against a plain restatement."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from labelloom.llm import subvectors

SCHEMA = "vec_id long, embedding array<float>, cluster string, v int"


def rows_of(n, dims, rng):
    rows = [(i, [rng.choice((-0.5, -0.25, 0.0, 0.3, 0.9)) for _ in range(dims)], "clash", 1) for i in range(n)]
    rows += [rows[3], rows[3], (None, rows[2][1], None, None), (900, rows[3][1], None, None)]
    odd = [
        (901, None, "x", 1),
        (902, rows[0][1][:-1], "x", 1),
        (903, [None] + rows[0][1][1:], "x", 1),
        (904, [math.nan] + rows[0][1][1:], "x", 1),
        (905, [math.inf] + rows[0][1][1:], "x", 1),
        (906, [], "x", 1),
    ]
    return rows, odd


def plain(rows, k, rounds, scale):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, *_ in rows]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    found = [(i, *assign(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for i, d, n in found), key=repr)


@pytest.mark.parametrize("n,dims,k,block,chunk", [(120, 6, 5, 2, 7), (40, 7, 16, 3, 1000), (4, 8, 16, 2, 2)])
def test_equals_plain_clustering(spark, n, dims, k, block, chunk):
    rows, odd = rows_of(n, dims, random.Random(n))
    frame = spark.createDataFrame(rows + odd, SCHEMA).repartition(3)
    found = subvectors.cluster(frame, k=k, dims=dims, block=block, chunk_rows=chunk)
    ours = sorted((tuple(r) for r in found.collect()), key=repr)
    assert ours == plain(rows, k, 3, 64)


def test_encoding_is_lossless():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-4, 4, (500, 9)).astype(np.int32)
    dictionaries, codes = subvectors.encode(vectors, 2)
    assert (subvectors.decode(dictionaries, codes) == vectors).all()
    assert [len(np.unique(d, axis=0)) for d in dictionaries] == [len(d) for d in dictionaries]


def test_huge_components_and_empty_tables(spark):
    rows, _ = rows_of(20, 4, random.Random(1))
    huge = (77, [3e30, 0.0, 0.0, 0.0], "x", 1)
    edge = (78, [float(subvectors.LIMIT >> 6), 0.0, 0.0, 0.0], "x", 1)
    found = {r.vec_id: r for r in subvectors.cluster(spark.createDataFrame([*rows, huge, edge], SCHEMA), k=3, dims=4).collect()}
    assert found[77].cluster is None and found[77].distance is None and found[77].centroid_sha256 is None
    assert found[78].distance >= 0 and len(found) == 24
    empty = subvectors.cluster(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "cluster", "distance"]
