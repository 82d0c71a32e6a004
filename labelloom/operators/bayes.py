"""Naive Bayes for all tags, smoothing values and folds in one job.

Training counts without a fold are the totals minus the fold's counts, so nothing is refitted. A model is a set of
term weights and a bias per tag: the log odds of a document are the bias plus the weights of its terms.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.evaluate import binary_f1

# The smoothing grid, and what replaces a smoothing of zero.
ALPHAS = (0.0, 1.0, 2.0)
ALPHA_FLOOR = 1e-10


def _smoothing(alpha: float | Column) -> Column:
    return F.greatest(alpha if isinstance(alpha, Column) else F.lit(float(alpha)), F.lit(ALPHA_FLOOR))


def _cell(label: bool, fold: int) -> str:
    return f"{'p' if label else 'n'}{fold}"


def _cells(value: Column, folds: int) -> list[Column]:
    """Sums of ``value`` per (label, fold): ``p0, n0, p1, ...``"""
    return [
        F.sum(F.when((F.col("label") == label) & (F.col("fold") == fold), value).otherwise(0)).alias(_cell(label, fold))
        for fold in range(folds)
        for label in (True, False)
    ]


def _without(prefix: str, label: bool, folds: int, fold: int | None) -> Column:
    """Total of a label minus the given fold (``None``: the whole total)."""
    kept = [F.col(prefix + _cell(label, f)) for f in range(folds) if f != fold]
    return reduce(lambda a, b: a + b, kept, F.lit(0)).cast("double")


class _Bernoulli:
    name = "bernoulli_nb"

    @staticmethod
    def value() -> Column:
        return F.lit(1)

    @staticmethod
    def sizes(samples: DataFrame, terms: DataFrame, folds: int) -> DataFrame:
        """Documents per (label, fold) of each tag."""
        cells = samples.groupBy("tag").agg(*_cells(F.lit(1), folds))
        return cells.select("tag", *[F.col(c).alias("size_" + c) for c in cells.columns[1:]])

    @staticmethod
    def weight(folds: int, fold: int | None, alpha: Column) -> Column:
        def odds(label: bool) -> Column:
            n, c = _without("size_", label, folds, fold), _without("", label, folds, fold)
            return F.log(c + alpha) - F.log(n - c + alpha)

        return odds(True) - odds(False)

    @staticmethod
    def bias_share(folds: int, fold: int | None, alpha: Column) -> Column:
        """A term's part of the bias: the log odds of its absence."""

        def absent(label: bool) -> Column:
            n, c = _without("size_", label, folds, fold), _without("", label, folds, fold)
            return F.log((n - c + alpha) / (n + 2 * alpha))

        return absent(True) - absent(False)

    @staticmethod
    def score(weight: Column) -> Column:
        return weight


class _Multinomial:
    name = "multinomial_nb"

    @staticmethod
    def value() -> Column:
        return F.col("tf")

    @staticmethod
    def sizes(samples: DataFrame, terms: DataFrame, folds: int) -> DataFrame:
        """Tokens per (label, fold) and vocabulary size of each tag."""
        per_term = terms.groupBy("tag", "term").agg(*_cells(F.col("tf"), folds))
        sums = [F.sum(c).alias("size_" + c) for c in per_term.columns[2:]]
        return per_term.groupBy("tag").agg(*sums, F.count("*").alias("vocabulary"))

    @staticmethod
    def weight(folds: int, fold: int | None, alpha: Column) -> Column:
        def log_share(label: bool) -> Column:
            tokens, c = _without("size_", label, folds, fold), _without("", label, folds, fold)
            return F.log((c + alpha) / (tokens + F.col("vocabulary") * alpha))

        return log_share(True) - log_share(False)

    @staticmethod
    def bias_share(folds: int, fold: int | None, alpha: Column) -> Column:
        return F.lit(0.0)

    @staticmethod
    def score(weight: Column) -> Column:
        return weight * F.col("tf")


FAMILIES = {family.name: family for family in (_Bernoulli, _Multinomial)}


def _priors(samples: DataFrame, folds: int) -> DataFrame:
    cells = samples.groupBy("tag").agg(*_cells(F.lit(1), folds))
    return cells.select("tag", *[F.col(c).alias("docs_" + c) for c in cells.columns[1:]])


def _log_prior(folds: int, fold: int | None) -> Column:
    return F.log(_without("docs_", True, folds, fold)) - F.log(_without("docs_", False, folds, fold))


def _vocabulary(samples: DataFrame, terms: DataFrame, family, folds: int) -> DataFrame:
    """One row per (tag, term) with its counts per (label, fold), added up before the shuffle, and the tag's sizes."""
    counts = terms.groupBy("tag", "term").agg(*_cells(family.value(), folds))
    return counts.join(family.sizes(samples, terms, folds), "tag")


def prune_rare_terms(terms: DataFrame, min_documents: int) -> DataFrame:
    """Drop terms that occur in fewer documents of a tag's sample; a setting of the vocabulary, off by default."""
    kept = terms.groupBy("tag", "term").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_documents)
    return terms.join(kept.select("tag", "term"), ["tag", "term"], "left_semi")


def fold_scores(
    samples: DataFrame, terms: DataFrame, model: str, alphas: Sequence[float] = ALPHAS, folds: int = 3
) -> DataFrame:
    """``(tag, model, alpha, fold, f1)`` on the left-out folds.

    ``samples``: ``(tag, id, label, fold)``; ``terms``: the same columns with ``(term, tf)``.
    """
    family = FAMILIES[model]
    names = [f"a{i}" for i in range(len(alphas))]
    vocabulary = _vocabulary(samples, terms, family, folds)

    def by_fold(of, alpha: float) -> Column:
        return F.array(*[of(folds, f, _smoothing(alpha)) for f in range(folds)])

    # A term's weights without each fold are computed once per (tag, term); a row picks those of its own fold.
    weights = vocabulary.select("tag", "term", *[by_fold(family.weight, a).alias(n) for n, a in zip(names, alphas)])
    summed = (
        terms.join(weights, ["tag", "term"])
        .groupBy("tag", "id")
        .agg(*[F.sum(family.score(F.get(n, F.col("fold")))).alias(n) for n in names])
    )
    shares = vocabulary.groupBy("tag").agg(
        *[
            F.array(*[F.sum(family.bias_share(folds, f, _smoothing(a))) for f in range(folds)]).alias("share_" + n)
            for n, a in zip(names, alphas)
        ]
    )
    by_tag = _priors(samples, folds).join(shares, "tag", "left")
    scored = samples.join(summed, ["tag", "id"], "left").join(by_tag, "tag")
    prior = F.get(F.array(*[_log_prior(folds, f) for f in range(folds)]), F.col("fold"))
    outcomes = F.array(
        *[
            F.struct(
                F.lit(float(a)).alias("alpha"),
                (
                    F.coalesce(F.col(n), F.lit(0.0))
                    + F.coalesce(F.get("share_" + n, F.col("fold")), F.lit(0.0))
                    + prior
                    > 0
                ).alias("predicted"),
            )
            for n, a in zip(names, alphas)
        ]
    )
    long = scored.select("tag", "label", "fold", F.explode(outcomes).alias("o")).select("tag", "label", "fold", "o.*")
    return (
        long.groupBy("tag", "alpha", "fold")
        .agg(binary_f1(F.col("label"), F.col("predicted")).alias("f1"))
        .select("tag", F.lit(model).alias("model"), "alpha", "fold", "f1")
    )


def fit(samples: DataFrame, terms: DataFrame, model: str, best: DataFrame, folds: int = 3) -> DataFrame:
    """Models on whole samples: ``(tag, term, weight, bias)``, with the ``alpha`` that ``best (tag, alpha)`` names."""
    family = FAMILIES[model]
    counted = _vocabulary(samples, terms, family, folds).join(best.select("tag", "alpha"), "tag")
    alpha = _smoothing(F.col("alpha"))
    weights = counted.select(
        "tag",
        "term",
        family.weight(folds, None, alpha).alias("weight"),
        family.bias_share(folds, None, alpha).alias("share"),
    )
    shares = weights.groupBy("tag").agg(F.sum("share").alias("share"))
    prior = _priors(samples, folds).select("tag", _log_prior(folds, None).alias("prior"))
    biases = shares.join(prior, "tag").select("tag", (F.col("share") + F.col("prior")).alias("bias"))
    return weights.join(biases, "tag").select("tag", "term", "weight", "bias")
