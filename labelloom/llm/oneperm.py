"""Document fingerprints by one-permutation MinHash.

Every shingle of five words is hashed once; its high bits choose one of ``BINS`` bins and the least of the rest stays.
Empty bins are filled by optimal densification: each walks through its own fixed pseudo-random sequence of bins to the
first that is not empty and takes its value, so equal bins of two texts still agree with the probability of their
Jaccard likeness. ``BITS`` low-order bits a bin are packed; the share of equal bins is corrected for those that agree
by chance.

Defined cases: a null text is empty; a text without words has an all-zero fingerprint, is fully like another such text
and unlike any with words; repeated ids follow each other in order of text; a null id is the lowest; the only document is its own neighbour; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm import shingles
from labelloom.session import ship_package, stage

BINS, BITS = 256, 4
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def densify(least: np.ndarray) -> np.ndarray:
    """Fill the empty bins of rows that have any other."""
    docs, bins = np.nonzero((least == EMPTY) & (least != EMPTY).any(axis=1)[:, None])
    out, k, attempt = least.copy(), least.shape[1], 1
    while len(docs):
        step = shingles.mix(bins.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt))
        other = (step % np.uint64(k)).astype(np.int64)
        found = least[docs, other]
        full = found != EMPTY
        out[docs[full], bins[full]] = found[full]
        docs, bins, attempt = docs[~full], bins[~full], attempt + 1
    return out


def fingerprints(texts: pa.Array, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """Low-order bits per bin, a row per text, before packing; rows of texts without words are zero."""
    words, bounds = shingles.word_hashes(texts)
    hashes, places = shingles.shingle_hashes(words, bounds)
    owner = np.repeat(np.arange(len(texts)), np.diff(places))
    least = np.full(len(texts) * bins, EMPTY, dtype=np.uint64)
    shift = np.uint64(64 - bins.bit_length() + 1)
    np.minimum.at(least, owner * bins + (hashes >> shift).astype(np.int64), hashes & np.uint64((1 << int(shift)) - 1))
    least = densify(least.reshape(len(texts), bins))
    low = (shingles.mix(least) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    low[np.diff(places) == 0] = 0
    return low


def pack(low: np.ndarray, bits: int = BITS) -> np.ndarray:
    spread = (low[:, :, None] >> np.arange(bits, dtype=np.uint8)) & 1
    return np.packbits(spread.reshape(len(low), -1), axis=1, bitorder="little")


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Jaccard likeness from unpacked rows: the share of equal bins without those equal by chance."""
    chance = 2.0**-bits
    out = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)
    no_words = ~a.any(axis=1), ~b.any(axis=1)
    return np.where(no_words[0] | no_words[1], (no_words[0] & no_words[1]).astype(float), out)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = (
    "doc_id long, n_chars long, edited_digest binary, mark binary, edited_mark binary, near_edited double, near_next double"
)


def _record(doc_ids, texts: list[str], following: list[str], low: np.ndarray, next_low: np.ndarray) -> dict:
    made = [edited(t, n) for t, n in zip(texts, following)]
    edited_low = fingerprints(pa.array(made, pa.large_string()))
    return {
        "doc_id": doc_ids,
        "n_chars": pa.array(list(map(len, texts)), pa.int64()),
        "edited_digest": pa.array([hashlib.sha256(t.encode()).digest() for t in made], pa.binary()),
        "mark": pa.array([r.tobytes() for r in pack(low)], pa.binary()),
        "edited_mark": pa.array([r.tobytes() for r in pack(edited_low)], pa.binary()),
        "near_edited": pa.array(likeness(low, edited_low)),
        "near_next": pa.array(likeness(low, next_low)),
    }


def with_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    The next document is the one with the next lower id, and the highest after the lowest. Documents are sorted by
    range once; neighbours meet in their task, and only each task's first and last text travel further.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches):
        from pyspark import TaskContext

        from labelloom.llm import shingles as s
        from labelloom.llm.oneperm import _record, fingerprints

        part, before, last, begun = TaskContext.get().partitionId(), None, None, False
        schema = None
        for batch in batches:
            for at, piece in s.slices(batch.column("text")):
                ids, texts, low = batch.column("doc_id").slice(at, len(piece)), piece.to_pylist(), fingerprints(piece)
                first_text = texts[0]
                here = _record(
                    ids,
                    texts,
                    [before[0] if begun else "", *texts[:-1]],
                    low,
                    np.vstack([before[1] if begun else low[:1], low[:-1]]),
                )
                n = len(texts)
                here |= {
                    "part": pa.array([part] * n, pa.int64()),
                    "opens": pa.array([not begun] + [False] * (n - 1)),
                    "edge_text": pa.array([None if begun else first_text] + [None] * (n - 1), pa.string()),
                }
                made = pa.RecordBatch.from_pydict(here)
                schema = made.schema
                yield made
                before, last, begun = (texts[-1], low[-1:]), texts[-1], True
        if begun:
            closing = {name: pa.nulls(1, schema.field(name).type) for name in schema.names}
            closing |= {"part": pa.array([part], pa.int64()), "edge_text": pa.array([last], pa.string())}
            yield pa.RecordBatch.from_pydict(closing)

    def join_edges(batches):
        from labelloom.llm import shingles as s
        from labelloom.llm.oneperm import _record, fingerprints

        for batch in batches:
            for at, piece in s.slices(batch.column("text")):
                following = batch.column("next_text").slice(at, len(piece))
                yield pa.RecordBatch.from_pydict(
                    _record(
                        batch.column("doc_id").slice(at, len(piece)),
                        piece.to_pylist(),
                        following.to_pylist(),
                        fingerprints(piece),
                        fingerprints(following.cast(pa.large_string())),
                    )
                )

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    made = stage(ordered.mapInArrow(run, _COLUMNS + ", part long, opens boolean, edge_text string"), "fingerprints")
    edges = made.where("edge_text IS NOT NULL").select("doc_id", "part", "opens", "edge_text")
    closing = edges.where("opens IS NULL").select(F.col("part").alias("next_part"), F.col("edge_text").alias("next_text"))
    parts = closing.select(F.col("next_part").alias("part"))
    # One number per task of the sort; texts are joined to them afterwards.
    turn = Window.orderBy("part")
    linked = parts.select(
        "part", F.coalesce(F.lag("part").over(turn), F.max("part").over(Window.partitionBy())).alias("next_part")
    )
    opening = edges.where("opens").withColumnRenamed("edge_text", "text").join(linked, "part").join(closing, "next_part")
    joined = opening.select("doc_id", "text", "next_text").mapInArrow(join_edges, _COLUMNS)
    columns = [c.split()[0] for c in _COLUMNS.split(", ")]
    return (
        made.where("NOT opens")
        .select(*columns)
        .union(joined)
        .select(
            "doc_id",
            "n_chars",
            F.lower(F.hex("edited_digest")).alias("edited_sha256"),
            F.lower(F.hex("mark")).alias("fingerprint"),
            F.lower(F.hex("edited_mark")).alias("edited_fingerprint"),
            "near_edited",
            "near_next",
        )
    )
