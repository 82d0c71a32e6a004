"""Tag statistics, selections and co-occurrence."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.common import IMPORTANT, SPEC, Area, with_sql
from labelloom.functions.text import tag_array
from labelloom.operators import tags as T
from labelloom.session import new_path, stage
from labelloom.sources import sinks
from labelloom.sources.questions import questions_from_benchmark, questions_from_documents

area = Area()
TAG = "fr"


@area.add(with_sql("SELECT id, array_to_string(string_split(tags, ' '), ',') AS tags FROM docs"))
def tag_split(spark, folder):
    questions = questions_from_documents(spark, folder)
    return questions.select("id", F.array_join(tag_array(F.col("tags")), ",").alias("tags"))


@area.add(with_sql("SELECT tag, count FROM hist"))
def tag_histogram(spark, folder):
    return T.tag_histogram(questions_from_documents(spark, folder))


@area.add(
    with_sql(
        """SELECT len(string_split(tags, ' '))::BIGINT AS tag_count, count(*) AS questions FROM docs GROUP BY 1"""
    )
)
def tags_per_question(spark, folder):
    return T.tags_per_question(questions_from_documents(spark, folder))


@area.add(with_sql("SELECT count, count(*) AS tags FROM hist GROUP BY count ORDER BY count LIMIT 100"))
def counts_of_counts(spark, folder):
    return T.counts_of_counts(T.tag_histogram(questions_from_documents(spark, folder)))


@area.add(
    with_sql(
        f"""SELECT (SELECT count(*) FROM docs) AS rows, count(*) AS tags, round(avg(count), 6) AS mean_tag_use,
            count(*) FILTER (WHERE count >= {IMPORTANT}) AS selected_tags FROM hist"""
    )
)
def corpus_overview(spark, folder):
    overview = T.corpus_overview(questions_from_documents(spark, folder), IMPORTANT)
    return overview.withColumn("mean_tag_use", F.round("mean_tag_use", 6))


@area.add(with_sql(f"SELECT tag, count FROM hist WHERE count >= {IMPORTANT}"))
def important_tags(spark, folder):
    return T.important_tags(T.tag_histogram(questions_from_documents(spark, folder)), IMPORTANT)


@area.add(with_sql("SELECT tag, count FROM frequent"))
def frequent_tags(spark, folder):
    return T.frequent_tags(T.tag_histogram(questions_from_documents(spark, folder)), SPEC.more_than)


@area.add(with_sql("SELECT tag, id FROM uses"))
def inverted_index(spark, folder):
    path = new_path(spark, "inverted-index")
    sinks.write_inverted_index(T.tag_uses(questions_from_documents(spark, folder)), path)
    return spark.read.parquet(path)


@area.add(
    with_sql(
        f"""SELECT id, title, body, tags FROM docs WHERE id IN (
            SELECT u.id FROM uses u JOIN hist h ON u.tag = h.tag WHERE h.count >= {IMPORTANT})"""
    )
)
def important_records(spark, folder):
    questions = questions_from_documents(spark, folder)
    selected = T.important_tags(T.tag_histogram(questions), IMPORTANT)
    return T.important_records(questions, selected)


@area.add(
    with_sql(
        f"""SELECT u.tag, count(*) AS shared FROM uses u JOIN frequent f ON u.tag = f.tag
            WHERE u.id IN (SELECT id FROM uses WHERE tag = '{TAG}') GROUP BY u.tag"""
    )
)
def neighbouring_tags(spark, folder):
    questions = questions_from_documents(spark, folder)
    candidates = T.frequent_tags(T.tag_histogram(questions), SPEC.more_than)
    return T.neighbouring_tags(questions, TAG, candidates)


@area.add(
    with_sql(
        """SELECT a.tag, b.tag AS other, count(*) AS shared FROM uses a JOIN uses b ON a.id = b.id AND a.tag <> b.tag
            WHERE a.tag IN (SELECT tag FROM frequent) AND b.tag IN (SELECT tag FROM frequent) GROUP BY ALL"""
    )
)
def tag_cooccurrence(spark, folder):
    """Neighbours of all frequent tags at once, with the number of questions they share."""
    tagged = stage(questions_from_documents(spark, folder).select("id", "tags"), "tagged")
    return T.tag_cooccurrence(tagged, T.frequent_tags(T.tag_histogram(tagged), SPEC.more_than))


# The benchmark's item ids serve as the ids of a small query sample.
@area.add(
    with_sql(
        """SELECT u.tag, min(u.id) AS first_id FROM uses u JOIN frequent f ON u.tag = f.tag
            WHERE u.id IN (SELECT item_id FROM benchmark) GROUP BY u.tag"""
    )
)
def tags_of_sample(spark, folder):
    questions = questions_from_documents(spark, folder)
    known = T.frequent_tags(T.tag_histogram(questions), SPEC.more_than)
    return T.tags_of_sample(questions, questions_from_benchmark(spark, folder), known)


@area.add(
    with_sql(
        """SELECT id, title, body, tags, array_to_string(string_split(tags, ' '), ',') AS target FROM docs
            WHERE id IN (SELECT item_id FROM benchmark)"""
    )
)
def sampled_queries(spark, folder):
    questions = questions_from_documents(spark, folder)
    rows = T.sampled_queries(questions, questions_from_benchmark(spark, folder))
    return rows.withColumn("target", F.array_join("target", ","))


@area.add(
    with_sql(
        """SELECT id, array_to_string(string_split(tags, ' '), ',') AS target FROM docs
            WHERE id IN (SELECT item_id FROM benchmark)"""
    )
)
def targets(spark, folder):
    rows = T.targets(questions_from_documents(spark, folder), questions_from_benchmark(spark, folder))
    return rows.withColumn("target", F.array_join("target", ","))


def _exported(spark, statistic, name, schema):
    path = new_path(spark, name)
    sinks.write_statistic(statistic, path)
    return spark.read.schema(schema).csv(path, header=True)


@area.add(with_sql("SELECT tag, count FROM hist"))
def tag_histogram_export(spark, folder):
    histogram = T.tag_histogram(questions_from_documents(spark, folder))
    return _exported(spark, histogram, "tag-histogram", "tag STRING, count LONG")


@area.add(
    with_sql(
        """SELECT len(string_split(tags, ' '))::BIGINT AS tag_count, count(*) AS questions FROM docs GROUP BY 1"""
    )
)
def tag_count_export(spark, folder):
    counts = T.tags_per_question(questions_from_documents(spark, folder))
    return _exported(spark, counts, "tag-counts", "tag_count LONG, questions LONG")


@area.add(
    with_sql(
        f"""SELECT row_number() OVER (ORDER BY count DESC, tag) - 1 AS index, tag FROM hist
            WHERE count >= {IMPORTANT}"""
    )
)
def important_tags_export(spark, folder):
    selected = T.important_tags(T.tag_histogram(questions_from_documents(spark, folder)), IMPORTANT)
    return _exported(spark, T.indexed_tags(selected), "important-tags", "index LONG, tag STRING")
