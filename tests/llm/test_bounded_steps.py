"""What a task takes apart at once and what one plan holds do not grow with batches and with the kinds of pairs."""

import numpy as np
import pyarrow as pa

from labelloom.llm import cotrain, probminhash


def kept_functions(monkeypatch, df):
    kept = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: kept.append(run))
    return kept


def test_the_classifier_measures_bounded_slices(spark, docs, monkeypatch):
    kept = kept_functions(monkeypatch, docs)
    blank = cotrain.Model(
        np.zeros((9, 1)), np.zeros(1), np.zeros(cotrain.BUCKETS), np.zeros(18), 0.0, np.zeros(cotrain.META + 1), np.array([1.0, 1.0, 0.0])
    )
    cotrain.score(docs, blank, add="p")
    cotrain.sampled_features(docs.withColumn("good", docs["p_good"] == 1))
    n, text = 6000, "river stone 12 " * 100
    columns = {name: pa.array(["x"] * n) for name in ("lang", "source", "spans")} | {"text": pa.array([text] * n)}
    columns |= {"doc_id": pa.array(range(n)), "n_chars": pa.array([len(text)] * n), "p_good": pa.array([1] * n), "good": pa.array([True] * n)}
    batch, measured, whole = pa.RecordBatch.from_pydict(columns), [], cotrain.text_features
    monkeypatch.setattr(cotrain, "text_features", lambda texts: measured.append(len(texts) * len(text)) or whole(texts))
    for run in kept:
        measured.clear()
        rows = [i for part in run([batch]) for i in part.column("doc_id").to_pylist()]
        assert rows == list(range(n)) and max(measured) <= 2_000_000 + len(text)


def test_pairs_are_taken_apart_in_portions(spark, docs, monkeypatch):
    kept = kept_functions(monkeypatch, docs)
    pairs = spark.createDataFrame([], "hub long, doc_id long, big boolean, a long, b long")
    sets = spark.createDataFrame([], "doc_id long, elements binary, weights binary")
    probminhash.compared(pairs.select("hub", "doc_id", "big"), sets)
    probminhash.verified(pairs.select("a", "b"), sets)
    n, size = 40, 20_000
    packed = [probminhash.pack_elements(np.arange(i, i + size, dtype=np.uint64)) for i in range(n)]
    columns = {name: pa.array(range(n)) for name in ("hub", "doc_id", "a", "b")} | {"big": pa.array([True] * n)}
    columns |= {"ea": pa.array([packed[0]] * n), "eb": pa.array(packed), "wa": pa.array([b""] * n), "wb": pa.array([b""] * n)}
    for run, key in zip(kept, ("hub", "a"), strict=True):
        parts = list(run([pa.RecordBatch.from_pydict(columns)]))
        assert [i for part in parts for i in part.column(key).to_pylist()] == list(range(n))
        assert max(part.num_rows for part in parts) * 2 * size * probminhash.ELEMENT_BYTES <= 2_300_000


def test_kinds_of_pairs_are_not_joined_in_one_plan(spark, docs, monkeypatch):
    plans, whole = {}, probminhash.stage
    monkeypatch.setattr(probminhash, "stage", lambda df, name: plans.setdefault(name, df) and whole(df, name))
    probminhash.near_duplicates(docs)
    joins = {name: df._jdf.queryExecution().optimizedPlan().toString().count("Join ") for name, df in plans.items()}
    assert max(joins.values()) <= 8, joins
