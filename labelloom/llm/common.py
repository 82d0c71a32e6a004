"""What the training-data operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.session import stage

WORD = re.compile(r"\w+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``doc_id`` and the whole ``text`` (null: empty), with any further columns asked for."""
    return table(spark, folder, "documents").select("doc_id", *columns, text_of())


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is not among ``ids (doc_id)``; rows without an id stay."""
    key = fresh(docs, "dropped_id")
    dropped = ids.select(F.col("doc_id").alias(key))
    return docs.join(dropped, docs["doc_id"] == F.col(key), "left_anti")


def one_row_per_id(docs: DataFrame) -> DataFrame:
    """One row of every ``doc_id``, the least by text; rows without an id all stay."""
    place = fresh(docs, "place")
    order = Window.partitionBy("doc_id").orderBy("text")
    numbered = docs.withColumn(place, F.row_number().over(order))
    return numbered.where(F.col("doc_id").isNull() | (F.col(place) == 1)).select(*docs.columns)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; the optimizer would repeat it for every element of a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: str) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return WORD.findall(text.lower())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the undirected ``edges (a, b)``; a component is named by its least node.

    Alternating large and small stars: every step is a minimum per node and a join, both of which pre-aggregate or
    split under skew, and the number of rounds is logarithmic in practice. Each round is a written table.
    """
    current = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark = None
    while True:
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u > v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u")
        small = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        current = stage(small.where("a <> b").distinct(), "stars")
        found = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(found):
            break
        mark = tuple(found)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
