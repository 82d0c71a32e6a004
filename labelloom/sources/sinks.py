"""Writers, and readers of what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_SCHEMA = "id LONG, title STRING, body STRING, code ARRAY<STRING>, label BOOLEAN, tag STRING"


def write_clean_corpus(clean: DataFrame, path: str) -> None:
    """``id, title, body, code`` as Parquet; nothing happens if the corpus is there."""
    clean.write.mode("ignore").parquet(path)


def write_samples(sampled_documents: DataFrame, path: str, files_per_tag: int = 1) -> None:
    """One folder per tag. Overwrites, so that a second run does not double the data.

    Rows are spread by tag and a hash of the id, so a tag with a large sample may use several tasks and files.
    """
    slot = F.pmod(F.hash("id"), F.lit(files_per_tag))
    sampled_documents.repartition("tag", slot).write.mode("overwrite").partitionBy("tag").parquet(path)


def read_samples(spark: SparkSession, path: str, tag: str | None = None) -> DataFrame:
    """Sampled documents; a tag reads only its folder. The label comes as a number too, ready for models."""
    samples = spark.read.schema(SAMPLE_SCHEMA).parquet(path)
    if tag is not None:
        samples = samples.where(F.col("tag") == tag)
    return samples.withColumn("target", F.col("label").cast("double"))


def write_inverted_index(uses: DataFrame, path: str) -> None:
    """``(tag, id)`` ordered by tag. The range covers both columns, so a hot tag is cut into several files."""
    uses.select("tag", "id").repartitionByRange("tag", "id").sortWithinPartitions("tag", "id").write.mode(
        "ignore"
    ).parquet(path)


def write_score_table(scores: DataFrame, path: str) -> None:
    """One line per tag under a header; an existing table is left alone."""
    scores.write.mode("ignore").option("header", True).csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """``id`` and a true array of tags."""
    predictions.write.mode("overwrite").parquet(path)


def write_statistic(statistic: DataFrame, path: str) -> None:
    statistic.write.mode("overwrite").option("header", True).csv(path)


def pending_tags(tags: DataFrame, results: DataFrame) -> DataFrame:
    """Tags without a stored result."""
    return tags.join(results.select("tag"), "tag", "left_anti")
