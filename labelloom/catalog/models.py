"""Model selection, scoring and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.common import SPEC, STOP_WORDS, Area, with_sql
from labelloom.catalog.features import KEYWORDS, document_texts
from labelloom.catalog.sampling import drawn
from labelloom.functions.text import tag_array
from labelloom.operators import bayes, clean, evaluate, keywords, sampling, scoring
from labelloom.operators import features as X
from labelloom.operators import tags as T
from labelloom.session import new_path, stage
from labelloom.sources import sinks
from labelloom.sources.questions import questions_from_benchmark, questions_from_documents

area = Area()

# The same models stated term by term: every (tag, term, fold, alpha, label) gets its own smoothed share.
BAYES = {
    "grid": f"SELECT alpha, greatest(alpha, 1e-10) AS a FROM (SELECT unnest({list(bayes.ALPHAS)})::DOUBLE AS alpha)",
    "holds": f"SELECT unnest(range({SPEC.folds})) AS f",
    "labels_": "SELECT unnest([true, false]) AS label",
    "train_docs": """SELECT tag, f, label, count(*)::DOUBLE AS n FROM folded, holds WHERE fold <> f
        GROUP BY tag, f, label""",
    "train_terms": """SELECT tag, f, label, term, count(*)::DOUBLE AS c, sum(tf)::DOUBLE AS ctf
        FROM sample_terms, holds WHERE fold <> f GROUP BY tag, f, label, term""",
    "train_tokens": "SELECT tag, f, label, sum(ctf) AS total FROM train_terms GROUP BY tag, f, label",
    "vocabulary": "SELECT DISTINCT tag, term FROM sample_terms",
    "vocabulary_size": "SELECT tag, count(*) AS v FROM vocabulary GROUP BY tag",
    "cells": """SELECT v.tag, v.term, h.f, g.alpha, g.a, l.label, d.n, coalesce(c.c, 0) AS c,
        coalesce(c.ctf, 0) AS ctf, t.total, s.v
        FROM vocabulary v CROSS JOIN holds h CROSS JOIN grid g CROSS JOIN labels_ l
        JOIN train_docs d ON d.tag = v.tag AND d.f = h.f AND d.label = l.label
        JOIN train_tokens t ON t.tag = v.tag AND t.f = h.f AND t.label = l.label
        JOIN vocabulary_size s ON s.tag = v.tag
        LEFT JOIN train_terms c ON c.tag = v.tag AND c.term = v.term AND c.f = h.f AND c.label = l.label""",
    "bnb": """SELECT tag, term, f, alpha,
        sum((CASE WHEN label THEN 1 ELSE -1 END) * (ln((c + a) / (n + 2 * a)) - ln((n - c + a) / (n + 2 * a)))) AS weight,
        sum((CASE WHEN label THEN 1 ELSE -1 END) * ln((n - c + a) / (n + 2 * a))) AS share
        FROM cells GROUP BY tag, term, f, alpha""",
    "mnb": """SELECT tag, term, f, alpha,
        sum((CASE WHEN label THEN 1 ELSE -1 END) * ln((ctf + a) / (total + a * v))) AS weight
        FROM cells WHERE alpha = 1 GROUP BY tag, term, f, alpha""",
    "prior": "SELECT tag, f, sum(CASE WHEN label THEN ln(n) ELSE -ln(n) END) AS prior FROM train_docs GROUP BY tag, f",
    "bnb_bias": "SELECT tag, f, alpha, sum(share) AS share FROM bnb GROUP BY tag, f, alpha",
    "bnb_sums": """SELECT t.tag, t.id, w.alpha, sum(w.weight) AS s FROM sample_terms t
        JOIN bnb w ON w.tag = t.tag AND w.term = t.term AND w.f = t.fold GROUP BY t.tag, t.id, w.alpha""",
    "mnb_sums": """SELECT t.tag, t.id, w.alpha, sum(t.tf * w.weight) AS s FROM sample_terms t
        JOIN mnb w ON w.tag = t.tag AND w.term = t.term AND w.f = t.fold GROUP BY t.tag, t.id, w.alpha""",
    "guesses": """SELECT 'bernoulli_nb' AS model, s.tag, b.alpha, s.fold, s.label,
        coalesce(x.s, 0) + b.share + p.prior > 0 AS predicted
        FROM folded s JOIN prior p ON p.tag = s.tag AND p.f = s.fold
        JOIN bnb_bias b ON b.tag = s.tag AND b.f = s.fold
        LEFT JOIN bnb_sums x ON x.tag = s.tag AND x.id = s.id AND x.alpha = b.alpha
        UNION ALL
        SELECT 'multinomial_nb', s.tag, 1.0, s.fold, s.label, coalesce(x.s, 0) + p.prior > 0
        FROM folded s JOIN prior p ON p.tag = s.tag AND p.f = s.fold
        LEFT JOIN mnb_sums x ON x.tag = s.tag AND x.id = s.id""",
    "fold_f1": """SELECT tag, model, alpha, fold, CASE WHEN count(*) FILTER (WHERE label OR predicted) = 0 THEN 0.0
        ELSE 2.0 * count(*) FILTER (WHERE label AND predicted)
             / (count(*) FILTER (WHERE label) + count(*) FILTER (WHERE predicted)) END AS f1
        FROM guesses GROUP BY tag, model, alpha, fold""",
    "report": """SELECT tag, model, alpha, avg(f1) AS mean_f1, 2 * stddev_pop(f1) AS two_std FROM fold_f1
        GROUP BY tag, model, alpha""",
    "best": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tag, model
        ORDER BY round(mean_f1, 12) DESC, alpha) AS r FROM report) WHERE r = 1""",
    "chosen": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tag
        ORDER BY round(mean_f1, 12) DESC, model) AS r2 FROM best) WHERE r2 = 1""",
    # Models on whole samples with the best smoothing.
    "all_docs": "SELECT tag, label, count(*)::DOUBLE AS n FROM folded GROUP BY tag, label",
    "all_terms": "SELECT tag, label, term, count(*)::DOUBLE AS c FROM sample_terms GROUP BY tag, label, term",
    "all_cells": """SELECT v.tag, v.term, l.label, d.n, coalesce(c.c, 0) AS c, greatest(b.alpha, 1e-10) AS a
        FROM vocabulary v CROSS JOIN labels_ l JOIN all_docs d ON d.tag = v.tag AND d.label = l.label
        JOIN best b ON b.tag = v.tag AND b.model = 'bernoulli_nb'
        LEFT JOIN all_terms c ON c.tag = v.tag AND c.term = v.term AND c.label = l.label""",
    "model_terms": """SELECT tag, term,
        sum((CASE WHEN label THEN 1 ELSE -1 END) * (ln((c + a) / (n + 2 * a)) - ln((n - c + a) / (n + 2 * a)))) AS weight,
        sum((CASE WHEN label THEN 1 ELSE -1 END) * ln((n - c + a) / (n + 2 * a))) AS share
        FROM all_cells GROUP BY tag, term""",
    "model_bias": """SELECT m.tag, m.share + p.prior AS bias
        FROM (SELECT tag, sum(share) AS share FROM model_terms GROUP BY tag) m
        JOIN (SELECT tag, sum(CASE WHEN label THEN ln(n) ELSE -ln(n) END) AS prior FROM all_docs GROUP BY tag) p
        USING (tag)""",
    "doc_sums": """SELECT c.id, m.tag, sum(m.weight) AS s FROM counts c JOIN model_terms m ON m.term = c.term
        GROUP BY c.id, m.tag""",
    "accepted": """SELECT d.id, b.tag FROM docs d CROSS JOIN model_bias b
        LEFT JOIN doc_sums s ON s.id = d.id AND s.tag = b.tag WHERE coalesce(s.s, 0) + b.bias > 0""",
    "suggested": """SELECT d.id, coalesce(list(a.tag ORDER BY a.tag) FILTER (WHERE a.tag IS NOT NULL), []) AS tags,
        any_value(string_split(d.tags, ' ')) AS target FROM docs d LEFT JOIN accepted a ON a.id = d.id GROUP BY d.id""",
}


def bayes_sql(final: str, **more: str) -> str:
    return with_sql(final, **BAYES, **more)


def _training(spark, folder):
    """Questions, their sample with its folds, and the terms of the sample; the latter two as stored tables."""
    questions, samples = drawn(spark, folder)
    folded = stage(sampling.stratified_folds(samples, SPEC), "folds")
    terms = stage(X.sample_terms(folded, document_texts(spark, folder), STOP_WORDS), "sample-terms")
    return questions, folded, terms


def _fold_scores(folded, terms):
    bernoulli = bayes.fold_scores(folded, terms, "bernoulli_nb", bayes.ALPHAS, SPEC.folds)
    multinomial = bayes.fold_scores(folded, terms, "multinomial_nb", (1.0,), SPEC.folds)
    return bernoulli.unionByName(multinomial)


def _rounded(df, *columns):
    for column in columns:
        df = df.withColumn(column, F.round(column, 6))
    return df


def _report(spark, folder):
    _, folded, terms = _training(spark, folder)
    return evaluate.score_report(_fold_scores(folded, terms), "alpha")


FOLD_SCORES = "SELECT tag, model, alpha, fold, round(f1, 6) AS f1 FROM fold_f1 WHERE model = '{}'"


@area.add(bayes_sql(FOLD_SCORES.format("bernoulli_nb")))
def bernoulli_fold_scores(spark, folder):
    """F1 of Bernoulli naive Bayes on every left-out fold, all tags and smoothing values in one job."""
    _, folded, terms = _training(spark, folder)
    scores = bayes.fold_scores(folded, terms, "bernoulli_nb", bayes.ALPHAS, SPEC.folds)
    return _rounded(scores, "f1").withColumn("fold", F.col("fold").cast("long"))


@area.add(bayes_sql(FOLD_SCORES.format("multinomial_nb")))
def multinomial_fold_scores(spark, folder):
    _, folded, terms = _training(spark, folder)
    scores = bayes.fold_scores(folded, terms, "multinomial_nb", (1.0,), SPEC.folds)
    return _rounded(scores, "f1").withColumn("fold", F.col("fold").cast("long"))


@area.add(bayes_sql("SELECT tag, model, alpha, round(mean_f1, 6) AS mean_f1, round(two_std, 6) AS two_std FROM report"))
def score_report(spark, folder):
    return _rounded(_report(spark, folder), "mean_f1", "two_std")


@area.add(bayes_sql("SELECT tag, model, alpha, round(mean_f1, 6) AS mean_f1 FROM best"))
def grid_search(spark, folder):
    """The best parameters of every (tag, model)."""
    best = evaluate.best_params(_report(spark, folder), "alpha")
    return _rounded(best, "mean_f1").select("tag", "model", "alpha", "mean_f1")


@area.add(bayes_sql("SELECT tag, model, alpha, round(mean_f1, 6) AS mean_f1 FROM chosen"))
def best_model_per_tag(spark, folder):
    chosen = evaluate.best_model(evaluate.best_params(_report(spark, folder), "alpha"))
    return _rounded(chosen, "mean_f1").select("tag", "model", "alpha", "mean_f1")


MATRIX = """SELECT tag, round(max(mean_f1) FILTER (WHERE model = 'bernoulli_nb'), 6) AS bernoulli_nb,
    round(max(mean_f1) FILTER (WHERE model = 'multinomial_nb'), 6) AS multinomial_nb FROM report GROUP BY tag"""
FAMILIES = ("bernoulli_nb", "multinomial_nb")


@area.add(bayes_sql(MATRIX))
def score_matrix(spark, folder):
    return _rounded(evaluate.score_matrix(_report(spark, folder), FAMILIES), *FAMILIES)


@area.add(bayes_sql(MATRIX))
def score_table(spark, folder):
    """The score matrix written with a header, once, and read back."""
    path = new_path(spark, "score-table")
    matrix = _rounded(evaluate.score_matrix(_report(spark, folder), FAMILIES), *FAMILIES)
    sinks.write_score_table(matrix, path)
    sinks.write_score_table(matrix.limit(0), path)
    return spark.read.schema(matrix.schema).csv(path, header=True)


def fitted(spark, folder):
    """Questions, their sample, and stored Bernoulli models with the best smoothing of each tag."""
    questions, folded, terms = _training(spark, folder)
    scores = bayes.fold_scores(folded, terms, "bernoulli_nb", bayes.ALPHAS, SPEC.folds)
    best = evaluate.best_params(evaluate.score_report(scores, "alpha"), "alpha")
    return questions, folded, stage(bayes.fit(folded, terms, "bernoulli_nb", best, SPEC.folds), "models")


@area.add(
    bayes_sql(
        """SELECT m.tag, m.term, round(m.weight, 6) AS weight, round(b.bias, 4) AS bias
            FROM model_terms m JOIN model_bias b USING (tag)"""
    )
)
def bernoulli_models(spark, folder):
    models = fitted(spark, folder)[2]
    return models.select("tag", "term", F.round("weight", 6).alias("weight"), F.round("bias", 4).alias("bias"))


def _suggested(spark, folder):
    questions, _, models = fitted(spark, folder)
    documents = clean.document_terms(document_texts(spark, folder), STOP_WORDS)
    truth = questions.select("id", tag_array(F.col("tags")).alias("target"))
    return scoring.suggest_tags(documents, models), truth


@area.add(bayes_sql("SELECT id, array_to_string(tags, ' ') AS tags FROM suggested"))
def suggest_tags(spark, folder):
    """Every question scored against every tag's model."""
    return _suggested(spark, folder)[0].withColumn("tags", F.array_join("tags", " "))


@area.add(bayes_sql("SELECT id, array_to_string(tags, ' ') AS tags, len(tags)::BIGINT AS n FROM suggested"))
def prediction_table(spark, folder):
    path = new_path(spark, "predictions")
    sinks.write_predictions(_suggested(spark, folder)[0], path)
    stored = spark.read.parquet(path)
    return stored.select("id", F.array_join("tags", " ").alias("tags"), F.size("tags").cast("long").alias("n"))


@area.add(
    bayes_sql(
        """SELECT id, tag, list_contains(target, tag)::INT AS in_truth, list_contains(tags, tag)::INT AS in_prediction
            FROM (SELECT *, unnest(list_distinct(list_concat(target, tags))) AS tag FROM suggested)"""
    )
)
def prediction_alignment(spark, folder):
    aligned = evaluate.align(*_suggested(spark, folder))
    return aligned.select(
        "id", "tag", F.col("in_truth").cast("int").alias("in_truth"), F.col("in_prediction").cast("int").alias("in_prediction")
    )


DOCUMENT_F1 = {
    "document_scores": """SELECT id, CASE WHEN len(target) + len(tags) = 0 THEN 0.0 ELSE
        2.0 * len(list_intersect(target, tags)) / (len(target) + len(tags)) END AS f1,
        CASE WHEN len(target) + len(tags) = 0 THEN 0.0 ELSE 2.0 * len(tags)
        / (len(tags) + len(list_distinct(list_concat(target, tags)))) END AS f1_alias_compat FROM suggested"""
}


@area.add(
    bayes_sql(
        "SELECT id, round(f1, 6) AS f1, round(f1_alias_compat, 6) AS f1_alias_compat FROM document_scores", **DOCUMENT_F1
    )
)
def document_f1(spark, folder):
    return _rounded(evaluate.document_f1(*_suggested(spark, folder)), "f1", "f1_alias_compat")


@area.add(
    bayes_sql(
        """SELECT count(*) AS documents, round(avg(f1), 6) AS mean_f1,
            round(avg(f1_alias_compat), 6) AS mean_f1_alias_compat FROM document_scores""",
        **DOCUMENT_F1,
    )
)
def mean_document_f1(spark, folder):
    scores = evaluate.document_f1(*_suggested(spark, folder))
    return _rounded(evaluate.mean_document_f1(scores), "mean_f1", "mean_f1_alias_compat")


@area.add(
    bayes_sql(
        """SELECT tag, round(CASE WHEN count(*) FILTER (WHERE t OR p) = 0 THEN 0.0 ELSE
            2.0 * count(*) FILTER (WHERE t AND p) / (count(*) FILTER (WHERE t) + count(*) FILTER (WHERE p)) END, 6) AS f1
            FROM (SELECT b.tag, list_contains(s.target, b.tag) AS t, list_contains(s.tags, b.tag) AS p
                  FROM suggested s CROSS JOIN model_bias b) GROUP BY tag"""
    )
)
def binary_f1(spark, folder):
    """F1 of every tag's model over all questions."""
    questions = questions_from_documents(spark, folder)
    known = T.frequent_tags(T.tag_histogram(questions), SPEC.more_than)
    aligned = evaluate.align(*_suggested(spark, folder)).join(known.select("tag"), "tag", "left_semi")
    return aligned.groupBy("tag").agg(
        F.round(evaluate.binary_f1(F.col("in_truth"), F.col("in_prediction")), 6).alias("f1")
    )


AFTER_CANDIDATES = ("gram_weights", "gram_unit", "gram_top", "gram_mean")


@area.add(
    bayes_sql(
        """SELECT q.id, concat_ws(' ', nullif((SELECT string_agg(tag, ' ' ORDER BY tag) FROM query_accepted a
            WHERE a.id = q.id), ''), (SELECT term FROM gram_mean g WHERE g.id = q.id AND g.rank = 1)) AS tags
            FROM query_words q""",
        **{name: text for name, text in KEYWORDS.items() if name not in AFTER_CANDIDATES},
        query_sums="""SELECT q.id, m.tag, sum(m.weight) AS s
            FROM (SELECT DISTINCT id, unnest(w) AS term FROM query_words) q JOIN model_terms m ON m.term = q.term
            GROUP BY q.id, m.tag""",
        query_accepted="""SELECT q.id, b.tag FROM query_words q CROSS JOIN model_bias b
            LEFT JOIN query_sums s ON s.id = q.id AND s.tag = b.tag WHERE coalesce(s.s, 0) + b.bias > 0""",
        query_candidates="""SELECT id, tag FROM query_accepted
            UNION SELECT q.id, c.tag FROM query_words q, candidates c""",
        gram_weights="""SELECT q.id, n.tag, q.term, q.tf * (ln((n.n + 2) / (coalesce(d.df, 0) + 2)) + 1) AS w
            FROM query_grams q JOIN query_candidates c ON c.id = q.id JOIN gram_n n ON n.tag = c.tag
            LEFT JOIN gram_df d ON d.tag = c.tag AND d.term = q.term""",
        **{name: KEYWORDS[name] for name in AFTER_CANDIDATES if name != "gram_weights"},
    )
)
def suggestions_with_keyword(spark, folder):
    """Suggestions for the benchmark passages with their best keyword appended."""
    questions, samples, models = fitted(spark, folder)
    texts = document_texts(spark, folder)
    queries = questions_from_benchmark(spark, folder).select("id", F.col("body").alias("text"))
    predictions = stage(scoring.suggest_tags(clean.document_terms(queries, STOP_WORDS), models), "suggestions")
    candidates = keywords.candidate_tags(queries, predictions, T.tag_histogram(questions))
    df, sizes = keywords.sample_statistics(samples, texts, STOP_WORDS)
    ranked = keywords.keywords_of_queries(keywords.keyword_scores(queries, candidates, df, sizes, STOP_WORDS))
    return keywords.with_keyword(predictions, ranked).select("id", F.array_join("tags", " ").alias("tags"))
