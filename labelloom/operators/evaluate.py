"""Scores of predictions, and the choice between models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Order of the models in tables and in ties. A naive Bayes comes first, then the trained families.
MODEL_ORDER = ("bernoulli_nb", "multinomial_nb", "linear_svc", "random_forest", "gradient_boosting")


def binary_f1(label: Column, predicted: Column) -> Column:
    """Aggregate: F1 of the positive class, 0 where nothing is positive."""
    hits = F.count_if(label & predicted)
    misses = F.count_if(label != predicted)
    return F.when(2 * hits + misses > 0, 2 * hits / (2 * hits + misses)).otherwise(0.0)


def align(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """``(id, tag, in_truth, in_prediction)`` over the union of both tag sets of every document."""
    both = truth.join(predictions, "id", "full_outer").select(
        "id",
        F.coalesce("target", F.array().cast("array<string>")).alias("target"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
    )
    return both.select("id", "target", "tags", F.explode(F.array_union("target", "tags")).alias("tag")).select(
        "id",
        "tag",
        F.array_contains("target", F.col("tag")).alias("in_truth"),
        F.array_contains("tags", F.col("tag")).alias("in_prediction"),
    )


def document_f1(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """``(id, f1, f1_alias_compat)`` of predicted ``tags`` against ``target``, joined by id.

    ``f1_alias_compat`` treats every tag of the union as true, which is how the published mean of 0.68 arose; it
    rises with false positives and is no measure of quality.
    """
    both = truth.join(predictions, "id")
    target, tags = F.array_distinct("target"), F.array_distinct("tags")
    common, union = F.size(F.array_intersect(target, tags)), F.size(F.array_union(target, tags))
    sizes = F.size(target) + F.size(tags)
    return both.select(
        "id",
        F.when(sizes > 0, 2 * common / sizes).otherwise(0.0).alias("f1"),
        F.when(F.size(tags) + union > 0, 2 * F.size(tags) / (F.size(tags) + union))
        .otherwise(0.0)
        .alias("f1_alias_compat"),
    )


def mean_document_f1(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count("*").alias("documents"),
        F.avg("f1").alias("mean_f1"),
        F.avg("f1_alias_compat").alias("mean_f1_alias_compat"),
    )


def score_report(fold_scores: DataFrame, *params: str) -> DataFrame:
    """Mean and twice the population deviation over the folds of each (tag, model, parameters)."""
    return fold_scores.groupBy("tag", "model", *params).agg(
        F.avg("f1").alias("mean_f1"), (2 * F.stddev_pop("f1")).alias("two_std")
    )


def best_params(report: DataFrame, *params: str) -> DataFrame:
    """Best parameters of each (tag, model); ties go to the first in parameter order."""
    rank = F.row_number().over(
        Window.partitionBy("tag", "model").orderBy(F.round("mean_f1", 12).desc(), *[F.asc(p) for p in params])
    )
    return report.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def best_model(report: DataFrame) -> DataFrame:
    """The model with the best mean of each tag; ties go to the earlier model."""
    place = F.array_position(F.array(*[F.lit(m) for m in MODEL_ORDER]), F.col("model"))
    rank = F.row_number().over(Window.partitionBy("tag").orderBy(F.round("mean_f1", 12).desc(), place))
    return report.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def score_matrix(report: DataFrame, models: tuple[str, ...] = MODEL_ORDER) -> DataFrame:
    """A row per tag, a column per model."""
    return report.groupBy("tag").pivot("model", list(models)).agg(F.max("mean_f1"))
