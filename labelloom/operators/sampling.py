"""Reproducible per-tag samples of documents with and without the tag."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.text import hash60, tag_array

CIRCLE = 1 << 60


@dataclass(frozen=True)
class SampleSpec:
    """60 documents with the tag, 1500 without, for tags used more than 2000 times, in 3 folds."""

    positives: int = 60
    negatives: int = 1500
    more_than: int = 2000
    folds: int = 3
    seed: int = 0
    strict: bool = True

    @property
    def rows(self) -> int:
        """The largest sample of a tag."""
        return self.positives + self.negatives

    @property
    def slice_rows(self) -> int:
        """Rows to look through for enough negatives: eight standard deviations above the mean, plus a few."""
        return self.negatives + ceil(8 * sqrt(self.negatives)) + 30


def first_per_key(df: DataFrame, key: str, order: list[Column], n: int, salts: int = 32) -> DataFrame:
    """The first ``n`` rows of each key, exact under skew: first per (key, salt), then per key.

    Both rank filters are pushed below their shuffles, so a map task sends at most ``n`` rows per key and salt, and
    the last step sees at most ``n * salts`` rows per key.
    """
    salted = df.withColumn("_salt", F.pmod(F.hash(*df.columns), F.lit(salts)))
    for keys in ((key, "_salt"), (key,)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        salted = salted.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return salted.drop("_salt")


def positive_sample(questions: DataFrame, selected: DataFrame, spec: SampleSpec) -> DataFrame:
    """Up to ``spec.positives`` documents of every selected tag, in hash order."""
    once = questions.select("id", F.explode(F.array_distinct(tag_array(F.col("tags")))).alias("tag"))
    uses = once.join(selected.select("tag"), "tag")
    keyed = uses.withColumn("_key", F.md5(F.concat_ws(":", "tag", "id", F.lit(spec.seed))))
    return first_per_key(keyed, "tag", [F.col("_key"), F.col("id")], spec.positives).select(
        "tag", "id", F.lit(True).alias("label")
    )


def negative_sample(questions: DataFrame, selected: DataFrame, spec: SampleSpec) -> DataFrame:
    """``spec.negatives`` documents without the tag, for every selected tag, without replacement.

    All documents lie on a circle at the hash of their id, a random permutation of the corpus. A tag starts at the
    hash of its name and takes the next documents that lack it. The circle is cut into slices of about
    ``spec.slice_rows`` documents; a tag is joined only with the slices it can need, which its use count tells, so a
    tag looks through a few slices and never through the corpus, and gaps in the ids do not matter. Should the
    slices ever hold too few documents the query fails instead of returning a short sample. A tag with fewer
    documents without it than asked for fails under ``strict`` and otherwise takes them all.

    The check is a branch of the result that yields no rows: whatever columns are read and however they are counted,
    it is run over every selected tag, also those without a single candidate.
    """
    total = questions.agg(F.count("*").alias("n")).scalar()
    # Documents, not uses: a tag may stand twice in a row.
    holders = (
        questions.select(F.explode(F.array_distinct(tag_array(F.col("tags")))).alias("tag"))
        .groupBy("tag")
        .agg(F.count("*").alias("holders"))
    )
    selected = selected.select("tag").join(holders, "tag").withColumnRenamed("holders", "count")
    slices = F.greatest(F.floor(total / F.lit(spec.slice_rows)), F.lit(1))
    place = F.floor(F.col("at") / F.lit(float(CIRCLE)) * slices)
    others = F.col("total") - F.col("count")
    wanted_slices = F.when(
        others > 0, F.least(F.ceil(F.lit(spec.slice_rows) * F.col("slices") / others) + 1, F.col("slices"))
    ).otherwise(F.col("slices"))
    starts = (
        selected.select("tag", "count")
        .withColumn("at", hash60(F.col("tag"), F.lit(spec.seed)))
        .withColumn("total", total)
        .withColumn("slices", slices)
        .withColumn("first", place)
        .withColumn("reach", wanted_slices)
        .select(
            "tag",
            F.col("at").alias("start"),
            "slices",
            "first",
            "reach",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("reach") - 1)).alias("step"),
        )
        .select(
            "tag",
            "start",
            (F.col("reach") == F.col("slices")).alias("whole"),
            "step",
            F.pmod(F.col("first") + F.col("step"), F.col("slices")).alias("slice"),
        )
    )
    documents = (
        questions.select("id", tag_array(F.col("tags")).alias("tags"))
        .withColumn("at", hash60(F.col("id"), F.lit(spec.seed)))
        .withColumn("slice", place)
    )
    # Without the whole circle, what lies before the start in the first slice would be the farthest away: not reached.
    reached = F.col("whole") | (F.col("step") > 0) | (F.col("at") >= F.col("start"))
    candidates = (
        documents.join(starts, "slice")
        .where(reached & ~F.array_contains(F.col("tags"), F.col("tag")))
        .select("tag", "id", F.pmod(F.col("at") - F.col("start"), F.lit(CIRCLE)).alias("distance"))
    )
    of_tag = Window.partitionBy("tag")
    chosen = (
        candidates.withColumn("rank", F.row_number().over(of_tag.orderBy("distance", "id")))
        .where(F.col("rank") <= spec.negatives)
        .select("tag", "id", F.lit(False).alias("label"))
    )
    found = chosen.groupBy("tag").agg(F.count("id").alias("found"))
    available = F.col("total") - F.col("count")
    wanted = F.lit(spec.negatives) if spec.strict else F.least(F.lit(spec.negatives), available)
    short = (
        selected.withColumn("total", total)
        .join(found, "tag", "left")
        .where(
            F.when(F.coalesce("found", F.lit(0)) >= wanted, F.lit(False)).otherwise(
                F.raise_error(F.concat(F.lit("too few documents without tag "), F.col("tag"))).cast("boolean")
            )
        )
    )
    none = short.select("tag", F.lit(None).cast("long").alias("id"), F.lit(False).alias("label"))
    return chosen.unionByName(none)


def tag_samples(questions: DataFrame, selected: DataFrame, spec: SampleSpec) -> DataFrame:
    """``(tag, id, label)`` for all selected tags ``(tag, count)`` in one job."""
    return positive_sample(questions, selected, spec).unionByName(negative_sample(questions, selected, spec))


def sample_index(samples: DataFrame) -> DataFrame:
    """Per document the tags it was sampled for, sorted."""
    return samples.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("tag", "label"))).alias("tags"))


def sampled_documents(samples: DataFrame, corpus: DataFrame) -> DataFrame:
    """A row per sampled (document, tag); ids the corpus lacks vanish.

    ``samples`` has at most (positives + negatives) rows per tag. Read from its table its size is known, so the
    optimizer sends it to the corpus partitions when it is small and otherwise shuffles by id behind a bloom filter.
    """
    return corpus.join(samples, "id")


def stratified_folds(samples: DataFrame, spec: SampleSpec) -> DataFrame:
    """Add ``fold``; each label of each tag is dealt evenly in hash order. A window holds one tag's sample."""
    dealt = Window.partitionBy("tag", "label").orderBy(
        F.md5(F.concat_ws(":", "tag", "id", F.lit(spec.seed), F.lit("fold"))), "id"
    )
    return samples.withColumn("fold", (F.row_number().over(dealt) - 1) % spec.folds)
