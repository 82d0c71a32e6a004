"""The corpus pipeline: documents to token ids, stage by stage.

Every stage is a function of (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return
the columns of their input; the rows that they reject are gone and the texts that they clean stay cleaned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import bpe, cotrain, probminhash, secrets, tiling
from labelloom.llm.common import fresh, one_row_per_id, table, without_ids
from labelloom.llm.queries import word_bpe
from labelloom.session import stage

LEAST_QUALITY = 0.5


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the co-trained classifier takes for bad or toxic."""
    model = cotrain.fit(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "p_good")
    return cotrain.score(docs, model, add=name).where(F.col(name) >= LEAST_QUALITY).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id of every class of near-duplicates."""
    classes = probminhash.near_duplicates(docs)
    dropped = stage(classes.where("doc_id <> class_id").select("doc_id"), "near-duplicates")
    return one_row_per_id(without_ids(docs, dropped))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover enough of a benchmark item."""
    pairs = tiling.contaminated_pairs(docs, table(spark, sf_dir, "benchmark"))
    return without_ids(docs, stage(pairs.select("doc_id").distinct(), "contaminated"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; ``n_chars`` follows the text where it changed."""
    scanned = secrets.scan(docs.select("text", F.struct("*").alias("row")))
    cleaned = secrets.redact(scanned)
    changed = F.size("spans") > 0
    columns = {
        "text": F.col("text"),
        "n_chars": F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return cleaned.select(*[columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit) of every document, with the digests of ids and of the decoded text."""
    encoded = bpe.encode_decode(docs, word_bpe(), keep_ids=True)
    return encoded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", quality_filter),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scan", redact_secrets),
    ("BPE encoding", encode),
]

# The classifier, the signatures and the tokenizer are beyond SQL; tests/llm compares the pipeline with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
