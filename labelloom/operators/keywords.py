"""Keywords: the heaviest TF-IDF terms of a query among a tag's sampled documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.text import count_terms, explode_once
from labelloom.operators.clean import document_terms

# Fixed value: keywords kept per (query, tag).
KEYWORDS = 10


def sample_statistics(samples: DataFrame, texts: DataFrame, stop_words: Sequence[str] = ()):
    """``(tag, term, df)`` over words and neighbour pairs, and ``(tag, n)``: all the keyword scores need of a sample."""
    sampled = texts.join(samples.select("id").distinct(), "id", "left_semi")
    per_document = document_terms(sampled, stop_words, bigrams=True).withColumn("terms", F.array_distinct("terms"))
    of_tag = per_document.join(samples.select("tag", "id"), "id")
    terms = explode_once(of_tag.select("tag", "terms"), "terms", "term")
    df = terms.groupBy("tag", "term").agg(F.count("*").alias("df"))
    return df, samples.groupBy("tag").agg(F.count("*").alias("n"))


def keyword_scores(
    queries: DataFrame,
    candidates: DataFrame,
    df: DataFrame,
    sizes: DataFrame,
    stop_words: Sequence[str] = (),
    keep: int = KEYWORDS,
) -> DataFrame:
    """``(id, tag, term, weight)``: the top terms of each query in the corpus "query + sample of the tag".

    ``queries``: ``(id, text)``; ``candidates``: ``(id, tag)``. Adding the query to the sample raises the sample's
    size and the document frequency of the query's terms by one, so nothing is refitted per query.
    """
    counts = count_terms(document_terms(queries, stop_words, bigrams=True), "terms")
    pairs = candidates.select("id", "tag").distinct().join(sizes, "tag")
    joined = counts.join(pairs, "id").join(df, ["tag", "term"], "left")
    share = (F.col("n") + 2) / (F.coalesce("df", F.lit(0)) + 2)
    weighed = joined.withColumn("_w", F.col("tf") * (F.log(share) + 1))
    pair = Window.partitionBy("id", "tag")
    weighed = weighed.withColumn("weight", F.col("_w") / F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(pair)))
    rank = F.row_number().over(pair.orderBy(F.round("weight", 12).desc(), F.desc("term")))
    return weighed.withColumn("rank", rank).where(F.col("rank") <= keep).select("id", "tag", "term", "weight", "rank")


def keywords_of_queries(scores: DataFrame) -> DataFrame:
    """``(id, term, weight, rank)``: the mean weight of a keyword over the candidate tags it came from."""
    means = scores.groupBy("id", "term").agg(F.avg("weight").alias("weight"))
    order = Window.partitionBy("id").orderBy(F.round("weight", 12).desc(), F.desc("term"))
    return means.withColumn("rank", F.row_number().over(order))


def default_candidates(queries: DataFrame, histogram: DataFrame, n: int = 3) -> DataFrame:
    """Every query with the ``n`` most used tags."""
    top = histogram.orderBy(F.desc("count"), F.asc("tag")).limit(n).agg(F.collect_list("tag").alias("tags"))
    return queries.select("id", F.explode(top.scalar()).alias("tag"))


def candidate_tags(queries: DataFrame, predictions: DataFrame, histogram: DataFrame, n: int = 3) -> DataFrame:
    """The predicted tags of each query and the most used tags; the predictions stay as they are."""
    predicted = predictions.select("id", F.explode("tags").alias("tag"))
    return predicted.unionByName(default_candidates(queries, histogram, n)).distinct()


def with_keyword(predictions: DataFrame, keywords: DataFrame, n: int = 1) -> DataFrame:
    """Predictions with the best ``n`` keywords appended."""
    best = (
        keywords.where(F.col("rank") <= n)
        .groupBy("id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda k: k["term"]).alias("_best"))
    )
    none = F.array().cast("array<string>")
    return predictions.join(best, "id", "left").select(
        "id", F.array_union("tags", F.coalesce("_best", none)).alias("tags")
    )
