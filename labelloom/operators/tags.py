"""Tag statistics, selections and co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.text import tag_array
from labelloom.session import stage


def tag_uses(questions: DataFrame) -> DataFrame:
    """``(tag, id)``, one row per use: the inverted index in long form."""
    return questions.select(F.explode(tag_array(F.col("tags"))).alias("tag"), "id")


def tag_histogram(questions: DataFrame) -> DataFrame:
    return tag_uses(questions).groupBy("tag").agg(F.count("*").alias("count"))


def tags_per_question(questions: DataFrame) -> DataFrame:
    per_row = questions.select(F.size(tag_array(F.col("tags"))).cast("long").alias("tag_count"))
    return per_row.groupBy("tag_count").agg(F.count("*").alias("questions"))


def counts_of_counts(histogram: DataFrame, first: int = 100) -> DataFrame:
    """How many tags are used 1, 2, 3, ... times; the report shows the first lines."""
    return histogram.groupBy("count").agg(F.count("*").alias("tags")).orderBy("count").limit(first)


def important_tags(histogram: DataFrame, at_least: int = 2000) -> DataFrame:
    return histogram.where(F.col("count") >= at_least)


def frequent_tags(histogram: DataFrame, more_than: int = 2000) -> DataFrame:
    """Tags that get a sample. The bound is strict here, unlike in ``important_tags``."""
    return histogram.where(F.col("count") > more_than)


def corpus_overview(questions: DataFrame, at_least: int = 2000) -> DataFrame:
    rows = questions.agg(F.count("*").alias("rows"))
    return tag_histogram(questions).agg(
        rows.scalar().alias("rows"),
        F.count("*").alias("tags"),
        F.avg("count").alias("mean_tag_use"),
        F.count_if(F.col("count") >= at_least).alias("selected_tags"),
    )


def indexed_tags(selected: DataFrame) -> DataFrame:
    """``(index, tag)`` export of a tag selection, most used first.

    The order is range-partitioned and written; rows are numbered inside their range and shifted by the sizes of the
    ranges before it, so no task holds the whole list. The only ordered window runs over one row per range.
    """
    order = (F.desc("count"), F.asc("tag"))
    numbered = stage(
        selected.select("tag", "count")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("tag", F.monotonically_increasing_id().alias("at"))
        .select("tag", F.shiftright("at", 33).alias("range"), F.col("at").bitwiseAND((1 << 33) - 1).alias("position")),
        "indexed-tags",
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("range").agg(F.count("*").alias("size"))
    offsets = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, "range").select((F.col("offset") + F.col("position")).alias("index"), "tag")


def important_records(questions: DataFrame, selected: DataFrame) -> DataFrame:
    """Questions with at least one selected tag, each once.

    Only ids and tags meet the selection; the matching ids are semi-joined back to the whole rows.
    """
    ids = tag_uses(questions).join(selected.select("tag"), "tag", "left_semi").select("id").distinct()
    return questions.join(ids, "id", "left_semi")


def neighbouring_tags(questions: DataFrame, tag: str, candidates: DataFrame) -> DataFrame:
    """Candidate tags that share a document with ``tag`` and in how many; a document's tags lie in its row."""
    together = (
        questions.select(tag_array(F.col("tags")).alias("tags"))
        .where(F.array_contains("tags", tag))
        .select(F.explode(F.array_distinct("tags")).alias("tag"))
        .groupBy("tag")
        .agg(F.count("*").alias("shared"))
    )
    return together.join(candidates.select("tag"), "tag", "left_semi")


def tag_cooccurrence(questions: DataFrame, selected: DataFrame) -> DataFrame:
    """``(tag, other, shared)``: in how many documents any two selected tags stand together, both ways round.

    Tags that are not selected go before pairs are made; pairs are made inside a document's row, each once in the order
    of its tags, and counted before the shuffle. No table is joined with itself.
    """
    uses = questions.select("id", F.explode(F.array_distinct(tag_array(F.col("tags")))).alias("tag"))
    kept = uses.join(selected.select("tag"), "tag", "left_semi")
    rows = kept.groupBy("id").agg(F.array_sort(F.collect_set("tag")).alias("tags")).where(F.size("tags") > 1)
    pairs = F.transform(
        "tags",
        lambda tag, i: F.transform(F.slice("tags", i + 2, F.size("tags")), lambda other: F.struct(tag.alias("tag"), other.alias("other"))),
    )
    counted = rows.select(F.explode(F.flatten(pairs)).alias("pair")).groupBy("pair.tag", "pair.other").agg(F.count("*").alias("shared"))
    both = F.explode(F.array(F.struct("tag", "other"), F.struct(F.col("other").alias("tag"), F.col("tag").alias("other"))))
    return counted.select(both.alias("pair"), "shared").select("pair.tag", "pair.other", "shared")


def tags_of_sample(questions: DataFrame, sample: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct known tags of the sampled documents with the id where each is first seen."""
    chosen = questions.select("id", "tags").join(sample.select("id"), "id", "left_semi")
    first_seen = tag_uses(chosen).groupBy("tag").agg(F.min("id").alias("first_id"))
    return first_seen.join(known.select("tag"), "tag", "left_semi")


def sampled_queries(questions: DataFrame, sample: DataFrame) -> DataFrame:
    """The sampled questions with their tags as an array: query text and target in one row."""
    chosen = questions.join(sample.select("id"), "id", "left_semi")
    return chosen.withColumn("target", tag_array(F.col("tags")))


def targets(questions: DataFrame, sample: DataFrame) -> DataFrame:
    """``(id, target)`` of the sampled documents; the texts are never read."""
    return sampled_queries(questions.select("id", "tags"), sample).select("id", "target")
