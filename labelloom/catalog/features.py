"""Text features and keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.common import STOP_LIST, STOP_WORDS, Area, tokens_sql, with_sql
from labelloom.catalog.sampling import drawn
from labelloom.operators import clean, keywords
from labelloom.operators import features as X
from labelloom.operators import tags as T
from labelloom.session import stage
from labelloom.sources.questions import questions_from_benchmark, texts_from_documents

area = Area()

TFIDF = {
    "df": "SELECT term, count(*) AS df FROM counts GROUP BY term",
    "weighed": """SELECT id, term, tf, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1 + df)) + 1) AS w
        FROM counts JOIN df USING (term)""",
}
HASHED = {
    "signed": """SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 4096 AS bucket,
        tf * CASE WHEN ('0x' || substr(md5(term), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS tf FROM counts""",
    "hashed": "SELECT id, bucket, abs(sum(tf))::BIGINT AS tf FROM signed GROUP BY id, bucket HAVING sum(tf) <> 0",
}
PAIRS = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
KEYWORDS = {
    "sample_grams": f"SELECT DISTINCT id, unnest({PAIRS}) AS term FROM (SELECT id, words AS w FROM tokens)",
    "gram_df": "SELECT s.tag, g.term, count(*) AS df FROM sample s JOIN sample_grams g USING (id) GROUP BY s.tag, g.term",
    "gram_n": "SELECT tag, count(*) AS n FROM sample GROUP BY tag",
    "query_words": f"""SELECT item_id AS id, list_filter({tokens_sql('text')}, lambda x: x NOT IN {STOP_LIST}) AS w
        FROM benchmark""",
    "query_grams": f"""SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({PAIRS}) AS term FROM query_words)
        GROUP BY id, term""",
    "candidates": "SELECT tag FROM frequent ORDER BY count DESC, tag LIMIT 3",
    "gram_weights": """SELECT q.id, n.tag, q.term, q.tf * (ln((n.n + 2) / (coalesce(d.df, 0) + 2)) + 1) AS w
        FROM query_grams q CROSS JOIN candidates c JOIN gram_n n ON n.tag = c.tag
        LEFT JOIN gram_df d ON d.tag = c.tag AND d.term = q.term""",
    "gram_unit": "SELECT id, tag, term, w / sqrt(sum(w * w) OVER (PARTITION BY id, tag)) AS weight FROM gram_weights",
    "gram_top": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, tag
        ORDER BY round(weight, 12) DESC, term DESC) AS rank FROM gram_unit) WHERE rank <= 10""",
    "gram_mean": """SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(weight, 12) DESC, term DESC) AS rank
        FROM (SELECT id, term, avg(weight) AS weight FROM gram_top GROUP BY id, term)""",
}


def document_texts(spark, folder):
    return clean.model_input(texts_from_documents(spark, folder))


@area.add(with_sql("SELECT id, term, tf FROM counts"))
def term_counts(spark, folder):
    return X.term_counts(document_texts(spark, folder), STOP_WORDS)


@area.add(
    with_sql(
        "SELECT id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM weighed", **TFIDF
    )
)
def tfidf(spark, folder):
    texts = document_texts(spark, folder)
    weights = X.tfidf(stage(X.term_counts(texts, STOP_WORDS), "term-counts"), texts.agg(F.count("*").alias("n")))
    return weights.withColumn("weight", F.round("weight", 6))


@area.add(
    with_sql(
        """SELECT tag, id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY tag, id)), 6) AS weight FROM (
            SELECT s.tag, s.id, s.term, s.tf, s.tf * (ln((1 + n.n) / (1 + d.df)) + 1) AS w FROM sample_terms s
            JOIN (SELECT tag, count(*) AS n FROM sample GROUP BY tag) n ON n.tag = s.tag
            JOIN (SELECT tag, term, count(*) AS df FROM sample_terms GROUP BY tag, term) d
              ON d.tag = s.tag AND d.term = s.term)"""
    )
)
def sample_tfidf(spark, folder):
    """Term weights of every tag's sample, all tags in one job."""
    samples = drawn(spark, folder)[1]
    terms = X.sample_terms(samples.drop("label"), document_texts(spark, folder), STOP_WORDS)
    weights = X.tfidf(terms, samples.groupBy("tag").agg(F.count("*").alias("n")), "tag")
    return weights.select("tag", "id", "term", "tf", F.round("weight", 6).alias("weight"))


@area.add(with_sql("SELECT id, bucket, tf FROM hashed", **HASHED))
def hashed_features(spark, folder):
    return X.hashed_counts(document_texts(spark, folder), STOP_WORDS)


def _keyword_scores(spark, folder):
    questions, samples = drawn(spark, folder)
    df, sizes = keywords.sample_statistics(samples, document_texts(spark, folder), STOP_WORDS)
    queries = questions_from_benchmark(spark, folder).select("id", F.col("body").alias("text"))
    candidates = keywords.default_candidates(queries, T.tag_histogram(questions))
    return keywords.keyword_scores(queries, candidates, df, sizes, STOP_WORDS)


@area.add(with_sql("SELECT id, tag, term, rank, round(weight, 6) AS weight FROM gram_top", **KEYWORDS))
def keyword_scores(spark, folder):
    scores = _keyword_scores(spark, folder)
    return scores.select("id", "tag", "term", F.col("rank").cast("long").alias("rank"), F.round("weight", 6).alias("weight"))


@area.add(with_sql("SELECT id, term, rank, round(weight, 6) AS weight FROM gram_mean", **KEYWORDS))
def keywords_over_candidate_tags(spark, folder):
    ranked = keywords.keywords_of_queries(_keyword_scores(spark, folder))
    return ranked.select("id", "term", F.col("rank").cast("long").alias("rank"), F.round("weight", 6).alias("weight"))
