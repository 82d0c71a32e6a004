"""Per-tag samples and what is stored of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.common import IMPORTANT, SPEC, Area, with_sql
from labelloom.operators import sampling as S
from labelloom.operators import tags as T
from labelloom.session import new_path, stage
from labelloom.sources import sinks
from labelloom.sources.questions import questions_from_documents, texts_from_documents

area = Area()
TAG = "good"


def drawn(spark, folder):
    """Questions and the stored sample of all frequent tags.

    Everything is drawn from one narrow stored table of ids and tags; the texts are not read for it.
    """
    questions = questions_from_documents(spark, folder)
    tagged = stage(questions.select("id", "tags"), "tagged")
    selected = stage(T.frequent_tags(T.tag_histogram(tagged), SPEC.more_than), "frequent-tags")
    return questions, stage(S.tag_samples(tagged, selected, SPEC), "samples")


def _label(df):
    return df.withColumn("label", F.col("label").cast("int"))


@area.add(with_sql("SELECT tag, id, label::INT AS label FROM sample"))
def tag_samples(spark, folder):
    return _label(drawn(spark, folder)[1])


@area.add(
    with_sql(
        """SELECT id, string_agg(tag || '=' || label::INT, ' ' ORDER BY tag, label) AS tags FROM sample GROUP BY id"""
    )
)
def sample_index(spark, folder):
    index = S.sample_index(drawn(spark, folder)[1])
    shown = F.transform("tags", lambda t: F.concat(t["tag"], F.lit("="), t["label"].cast("int")))
    return index.select("id", F.array_join(shown, " ").alias("tags"))


@area.add(with_sql("SELECT s.tag, d.id, d.title, d.body, s.label::INT AS label FROM sample s JOIN docs d USING (id)"))
def sampled_documents(spark, folder):
    samples = drawn(spark, folder)[1]
    return _label(S.sampled_documents(samples, texts_from_documents(spark, folder)).select("tag", "id", "title", "body", "label"))


def _stored(spark, folder):
    samples = drawn(spark, folder)[1]
    rows = S.sampled_documents(samples, texts_from_documents(spark, folder)).withColumn("code", F.array().cast("array<string>"))
    path = new_path(spark, "sample-files")
    sinks.write_samples(rows.select("tag", "id", "title", "body", "code", "label"), path)
    return path


@area.add(with_sql("SELECT s.tag, d.id, d.title, d.body, s.label::INT AS label FROM sample s JOIN docs d USING (id)"))
def sample_files(spark, folder):
    samples = sinks.read_samples(spark, _stored(spark, folder))
    return _label(samples.select("tag", "id", "title", "body", "label"))


@area.add(
    with_sql(
        f"""SELECT d.id, d.title || d.body AS text, s.label::INT::DOUBLE AS target
            FROM sample s JOIN docs d USING (id) WHERE s.tag = '{TAG}'"""
    )
)
def labelled_sample_scan(spark, folder):
    """One tag's folder, as text and numeric target."""
    samples = sinks.read_samples(spark, _stored(spark, folder), TAG)
    return samples.select("id", F.concat("title", "body").alias("text"), "target")


@area.add(with_sql("SELECT tag, id, label::INT AS label, fold FROM folded"))
def stratified_folds(spark, folder):
    folded = S.stratified_folds(drawn(spark, folder)[1], SPEC)
    return _label(folded).withColumn("fold", F.col("fold").cast("long"))


@area.add(
    with_sql(
        f"""SELECT f.tag FROM frequent f WHERE f.tag NOT IN (SELECT tag FROM hist WHERE count >= {2 * IMPORTANT})"""
    )
)
def pending_tags(spark, folder):
    """Frequent tags that have no result yet; the most used ones play the finished ones."""
    histogram = T.tag_histogram(questions_from_documents(spark, folder))
    done = T.important_tags(histogram, 2 * IMPORTANT)
    return sinks.pending_tags(T.frequent_tags(histogram, SPEC.more_than), done).select("tag")
