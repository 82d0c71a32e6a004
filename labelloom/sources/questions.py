"""Readers: question files, stop words, and the given tables seen as questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUESTION_SCHEMA = "id LONG, title STRING, body STRING, tags STRING"


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Give every core some rows of an input that is a single scan split; at most that split's bytes are shuffled."""
    spark = df.sparkSession
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(spark.sparkContext.defaultParallelism, key) if size < split else df


def read_questions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Question CSV with a header, quoted multi-line bodies and doubled quotes.

    A file with line breaks inside fields is read by one task; ``large_csv`` reads large files in ranges.
    """
    raw = spark.read.csv(path, schema=QUESTION_SCHEMA, header=True, multiLine=True, quote='"', escape='"')
    return raw.select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "body", "tags")])


def latest_by_id(df: DataFrame, order: str, key: str = "id") -> DataFrame:
    """One row per key, the one with the greatest ``order``, among equals the greatest in its other columns. Copies
    are reduced before the shuffle."""
    others = [c for c in df.columns if c not in (key, order)]
    best = F.max(F.struct(order, *others))
    return df.groupBy(key).agg(best.alias("_row")).select(key, *[F.col("_row")[c].alias(c) for c in others])


def load_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """``(word)``: one word per line, blanks stripped, each once."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, title, body)``: what needs no tags should start here and leave the texts out of the join with labels."""
    documents = spread_small(_table(spark, folder, "documents"), "doc_id")
    return documents.select(
        F.col("doc_id").alias("id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("body"),
    )


def questions_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as questions: first line = title, tags = language, source and label flags."""
    documents = spread_small(_table(spark, folder, "documents"), "doc_id")
    labels = _table(spark, folder, "labels")
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("body"),
        F.concat_ws(
            " ",
            "lang",
            "source",
            F.when(F.col("quality") == 1, "good"),
            F.when(F.col("toxic") == 1, "toxic"),
        ).alias("tags"),
    )


def questions_from_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as questions with HTML bodies; code openers are put in because the pages hold none."""
    html = F.col("html")
    for found, put in (("<article>", "x<pre>"), ("<b>", "y <code>"), ("<li>", "z<code>")):
        html = F.replace(html, F.lit(found), F.lit(put))
    return spread_small(_table(spark, folder, "pages"), "page_id").select(
        F.col("page_id").alias("id"), F.col("url").alias("title"), html.alias("body"), F.lit("").alias("tags")
    )


def questions_from_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages as untagged questions."""
    return spread_small(_table(spark, folder, "benchmark"), "item_id").select(
        F.col("item_id").alias("id"), F.lit("").alias("title"), F.col("text").alias("body"), F.lit("").alias("tags")
    )
