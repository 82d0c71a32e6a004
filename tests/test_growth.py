"""What tasks hold at once does not grow with their batches, and wide work is done once per distinct term."""

import hashlib
import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from labelloom.operators import features as X
from labelloom.operators import lsa, scoring


def test_products_take_documents_in_chunks():
    rng = np.random.default_rng(3)
    n, buckets = 2 * lsa.CHUNK + 5, 32
    lists = [sorted(rng.choice(buckets, size=i % 4, replace=False).tolist()) for i in range(n)]
    counts = [[int(x) for x in rng.integers(1, 5, size=len(row))] for row in lists]
    types = pa.list_(pa.int64())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array(lists, types), pa.array(counts, types)], names=["id", "buckets", "counts"]
    )
    idf = rng.uniform(1, 2, buckets)
    parts = list(lsa._dense(batch, idf))
    assert [len(rows) for _, rows in parts] == [lsa.CHUNK, lsa.CHUNK, 5]
    assert [i for ids, _ in parts for i in ids.to_pylist()] == list(range(n))
    expected = np.zeros((n, buckets))
    for i, (row, values) in enumerate(zip(lists, counts)):
        expected[i, row] = values
    expected = expected * idf
    norms = np.linalg.norm(expected, axis=1, keepdims=True)
    assert np.allclose(np.concatenate([rows for _, rows in parts]), expected / np.where(norms > 0, norms, 1))


def test_distinct_terms_are_hashed_once(monkeypatch):
    made = []
    monkeypatch.setattr(X, "md5", lambda raw: made.append(raw) or hashlib.md5(raw))
    rng = random.Random(4)
    documents = [rng.choices(["a", "bb", "ccc", "größe", "w1", "w2"], k=k) for k in (0, 50, 7, 0, 300)]
    buckets, counts = X._hashed(pa.array([[], *documents], pa.list_(pa.string())).slice(1), 3)
    assert len(made) == len(set(made))
    for words, found, amounts in zip(documents, buckets.to_pylist(), counts.to_pylist()):
        expected = {}
        for word in words:
            digest = hashlib.md5(word.encode()).hexdigest()
            sign = 1 if int(digest[8], 16) % 2 == 0 else -1
            expected[int(digest[:8], 16) % 3] = expected.get(int(digest[:8], 16) % 3, 0) + sign
        assert list(zip(found, amounts)) == sorted((b, abs(x)) for b, x in expected.items() if x)


def test_scoring_bounds_the_weights_of_a_slice():
    tags, words = [f"t{i:02d}" for i in range(30)], [f"w{i}" for i in range(200)]
    weights = pd.DataFrame([(t, w, (i * 7 + j) % 5 - 2.0) for i, t in enumerate(tags) for j, w in enumerate(words)])
    weights.columns = ["tag", "term", "weight"]
    block = scoring.ModelBlock(weights, pd.DataFrame({"tag": tags, "bias": 0.5}))
    rng = random.Random(1)
    texts = [rng.choices(words, k=k) for k in [0] * 3 + [200] * 400 + [40_000] + [5] * 50]
    terms = pa.array(texts, pa.list_(pa.string()))
    slices = list(block.slices(terms))
    assert sum(length for _, length in slices) == len(texts)
    assert [at for at, _ in slices] == np.cumsum([0] + [length for _, length in slices])[:-1].tolist()
    for at, length in slices:
        assert length == 1 or sum(map(len, texts[at : at + length])) * len(tags) <= scoring.ENTRIES
    parts = np.concatenate([block.scores(terms.slice(at, length), True) for at, length in slices])
    assert np.array_equal(parts, block.scores(terms, True))


def test_tfidf_does_not_sort_counts_by_term(spark):
    rows = [(i, f"w{j}", 1 + (i + j) % 3) for i in range(30) for j in range(i % 5)]
    counts = spark.createDataFrame(rows, "id long, term string, tf long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighed = X.tfidf(counts, counts.agg(F.count_distinct("id").alias("n")))
        plan = weighed._jdf.queryExecution().executedPlan().toString()
        norms = weighed.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("square")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert len(norms) == 24 and all(abs(r["square"] - 1) < 1e-12 for r in norms)
