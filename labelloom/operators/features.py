"""Term features in long form."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.text import count_terms, explode_once, explode_runs, with_term_runs
from labelloom.operators.clean import document_terms
from labelloom.session import ship_package

# Fixed value: number of hash buckets.
BUCKETS = 2**12
# Documents whose terms a task hashes and counts at once.
HASHED_AT_ONCE = 256


def term_counts(texts: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """``(id, term, tf)`` of ``(id, text)``; no shuffle."""
    return count_terms(document_terms(texts, stop_words), "terms")


def document_frequency(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys, "term").agg(F.count("*").alias("df"))


def tfidf(counts: DataFrame, sizes: DataFrame, *keys: str) -> DataFrame:
    """Unit-length ``tf * (ln((1 + n) / (1 + df)) + 1)`` within each combination of ``keys``.

    ``sizes`` holds the number of documents ``n`` per combination (one row without keys). The join on the term is an
    equi-join that splits hot terms at run time; frequencies, a row per term, are hashed, so that counts are not sorted
    for it. The norm is taken over one document's terms.
    """
    frequency = document_frequency(counts, *keys).hint("shuffle_hash")
    joined = counts.join(frequency, [*keys, "term"])
    if keys:
        joined = joined.join(sizes, list(keys))
        n = F.col("n")
    else:
        n = sizes.select("n").scalar()
    weighed = joined.withColumn("_w", F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*keys, "id")))
    return weighed.select(*counts.columns, (F.col("_w") / norm).alias("weight"))


def sample_texts(samples: DataFrame, texts: DataFrame) -> DataFrame:
    """Only the sampled rows of ``(id, text)``, each once, before any text is tokenised."""
    return texts.join(samples.select("id").distinct(), "id", "left_semi")


def sample_terms(samples: DataFrame, texts: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """``samples`` columns plus ``(term, tf)``: every sampled text is counted once and then shared by its tags."""
    per_document = with_term_runs(document_terms(sample_texts(samples, texts), stop_words), "terms")
    return explode_runs(per_document.join(samples, "id"))


def _hashed(terms: pa.Array, buckets: int) -> list[pa.Array]:
    """Buckets in order and their counts of every document of a list array of terms.

    Each distinct term is hashed once: 8 hex digits of its digest name the bucket, the ninth the sign. Signed counts of
    a bucket are added up and made absolute, and buckets that cancel out are dropped.
    """
    coded = terms.flatten().dictionary_encode()
    digests = [md5(term.encode()).digest() for term in coded.dictionary.to_pylist()]
    bucket = np.array([int.from_bytes(d[:4], "big") % buckets for d in digests], dtype=np.int64)
    sign = np.array([-1 if d[4] & 16 else 1 for d in digests], dtype=np.int64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy(zero_copy_only=False))
    cells = np.bincount(rows * buckets + bucket[codes], sign[codes], minlength=len(terms) * buckets)
    found = np.flatnonzero(cells)
    bounds = pa.array(np.searchsorted(found, np.arange(len(terms) + 1) * buckets), pa.int32())
    columns = found % buckets, np.abs(cells[found]).astype(np.int64)
    return [pa.ListArray.from_arrays(bounds, pa.array(column, pa.int64())) for column in columns]


def hashed_rows(texts: DataFrame, stop_words: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """``(id, buckets, counts)``: a sparse row of hashed counts for every text, also an empty one; no shuffle."""
    ship_package(texts.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, HASHED_AT_ONCE):
                part = batch.slice(at, HASHED_AT_ONCE)
                columns = [part.column("id"), *_hashed(part.column("terms"), buckets)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "buckets", "counts"])

    documents = document_terms(texts.select("id", "text"), stop_words).select("id", "terms")
    schema = f"id {documents.schema['id'].dataType.simpleString()}, buckets array<bigint>, counts array<bigint>"
    return documents.mapInArrow(run, schema)


def hashed_counts(texts: DataFrame, stop_words: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """``(id, bucket, tf)``, the rows of ``hashed_rows`` in long form."""
    entries = hashed_rows(texts, stop_words, buckets).select("id", F.arrays_zip("buckets", "counts").alias("entries"))
    return explode_once(entries, "entries", "entry").select(
        "id", F.col("entry.buckets").alias("bucket"), F.col("entry.counts").alias("tf")
    )
