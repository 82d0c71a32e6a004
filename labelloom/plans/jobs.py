"""The three jobs: prepare a corpus and its samples, survey models per tag, suggest tags and evaluate.

Every step is a Parquet table in a folder under ``home`` that belongs to the parameters, so other parameters never meet
old tables. A step whose table is complete is not run again, so a job that lost its driver continues where it stopped,
and later joins are planned with the sizes of the tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.text import tag_array
from labelloom.operators import bayes, clean, evaluate, families, forest, keywords, lsa, passes, sampling, scoring
from labelloom.operators import features as X
from labelloom.operators import tags as T
from labelloom.operators.sampling import SampleSpec
from labelloom.session import stage
from labelloom.sources import sinks
from labelloom.sources.questions import latest_by_id


@dataclass
class Workspace:
    spark: SparkSession
    home: str
    spec: SampleSpec = field(default_factory=SampleSpec)
    stop_words: Sequence[str] = ()
    sep: str = " "
    with_code: bool = False
    corpus: str = "questions"

    def path(self, name: str) -> str:
        """Below a folder named by everything that shapes the tables; ``corpus`` names the questions."""
        settings = repr((self.corpus, self.spec, sorted(self.stop_words), self.sep, self.with_code))
        return f"{self.home}/{self.corpus}-{hashlib.sha256(settings.encode()).hexdigest()[:12]}/{name}"

    def has(self, name: str) -> bool:
        """Whether a table was written to its end (its success marker exists)."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        marker = jvm.org.apache.hadoop.fs.Path(self.path(name), "_SUCCESS")
        return marker.getFileSystem(conf).exists(marker)

    def table(self, name: str, build: Callable[[], DataFrame] | None = None) -> DataFrame:
        if build is not None and not self.has(name):
            build().write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))


def prepare(work: Workspace, questions: DataFrame, order: str | None = None) -> None:
    """Clean corpus, tag statistics, inverted index, frequent tags, folded samples, one folder of rows per tag.

    With ``order``, a column of the questions, only the last row of every id is taken. Statistics and samples are drawn
    from a narrow table without texts.
    """
    rows = latest_by_id(questions, order) if order else questions
    stored = work.table("questions", lambda: rows)
    corpus = work.table("corpus", lambda: clean.clean_questions(stored))
    tagged = work.table("tagged", lambda: stored.select("id", "tags"))
    histogram = work.table("tag_histogram", lambda: T.tag_histogram(tagged))
    if not work.has("inverted_index"):
        sinks.write_inverted_index(T.tag_uses(tagged), work.path("inverted_index"))
    selected = work.table("frequent_tags", lambda: T.frequent_tags(histogram, work.spec.more_than))
    samples = work.table(
        "samples", lambda: sampling.stratified_folds(sampling.tag_samples(tagged, selected, work.spec), work.spec)
    )
    if not work.has("sample_files"):
        rows = sampling.sampled_documents(samples.drop("fold"), corpus)
        sinks.write_samples(rows, work.path("sample_files"))


def _texts(work: Workspace) -> DataFrame:
    return clean.model_input(work.table("corpus"), work.sep, work.with_code)


def survey_bayes(work: Workspace) -> DataFrame:
    """Report of both naive Bayes families over all tags, and the models of the Bernoulli one."""
    samples = work.table("samples")
    terms = work.table("sample_terms", lambda: X.sample_terms(samples, _texts(work), work.stop_words))

    def scores() -> DataFrame:
        folds = work.spec.folds
        bernoulli = bayes.fold_scores(samples, terms, "bernoulli_nb", bayes.ALPHAS, folds)
        return bernoulli.unionByName(bayes.fold_scores(samples, terms, "multinomial_nb", (1.0,), folds))

    report = evaluate.score_report(work.table("bayes_fold_scores", scores), "alpha")
    best = work.table("bayes_best", lambda: evaluate.best_params(report, "alpha"))
    bernoulli = best.where("model = 'bernoulli_nb'")
    work.table("bayes_models", lambda: bayes.fit(samples, terms, "bernoulli_nb", bernoulli, work.spec.folds))
    return best


def survey_families(work: Workspace, grids: families.Grids = families.Grids(), components: int = lsa.COMPONENTS) -> DataFrame:
    """Every family, grid point and fold of all tags on shared features; the winner of every tag, fitted and stored.

    Returns the best mean of every (tag, model); the matrix of tags and models is written as CSV.
    """
    samples, folds = work.table("samples"), work.spec.folds
    texts = X.sample_texts(samples, _texts(work))
    rows = work.table("sample_rows", lambda: X.hashed_rows(texts, work.stop_words))
    basis = work.table("lsa_basis", lambda: lsa.basis_table(work.spark, lsa.fit_lsa(rows, components)))
    features = work.table("family_features", lambda: lsa.project(rows, lsa.load_basis(basis)))

    def edges() -> DataFrame:
        found = forest.bin_edges(features)
        return work.spark.createDataFrame(list(enumerate(found.tolist())), "place int, edges array<double>")

    stored = work.table("bin_edges", edges)
    bins = forest.binned(features, _edges(stored))

    def blocks(values: DataFrame, kind: str) -> DataFrame:
        return passes.row_blocks(values.join(samples, "id"), work.spec.rows, folds, kind)

    reals = work.table("blocks", lambda: blocks(features, "f8"))
    whole = work.table("bin_blocks", lambda: blocks(bins, "u1"))
    scores = work.table("family_scores", lambda: families.fold_scores(reals, whole, components, folds, grids))
    best = work.table("family_best", lambda: families.best_of_families(families.report(scores)))
    won = work.table("winners", lambda: evaluate.best_model(best))
    work.table("winner_models", lambda: families.refit(won, reals, whole, components, folds))
    if not work.has("family_matrix"):
        sinks.write_statistic(evaluate.score_matrix(best), work.path("family_matrix"))
    return best


def _edges(stored: DataFrame) -> np.ndarray:
    return np.array([row["edges"] for row in stored.orderBy("place").collect()])


def _suggest_winners(work: Workspace, texts: DataFrame) -> DataFrame:
    documents = lsa.project(X.hashed_rows(texts, work.stop_words), lsa.load_basis(work.table("lsa_basis")))
    binned = stage(forest.binned(documents, _edges(work.table("bin_edges")), "bins"), "document-features")
    return families.suggest(binned, work.table("winner_models"))


def suggest(work: Workspace, questions: DataFrame, keyword: bool = False) -> DataFrame:
    """``(id, tags)`` for new questions, optionally with the best keyword: from every tag's winner once
    ``survey_families`` has run, from the Bernoulli models before."""
    texts = clean.model_input(clean.clean_questions(questions), work.sep, work.with_code)
    if work.has("winner_models"):
        predictions = _suggest_winners(work, texts)
    else:
        predictions = scoring.suggest_tags(clean.document_terms(texts, work.stop_words), work.table("bayes_models"))
    if not keyword:
        return predictions
    predictions = stage(predictions, "suggestions")
    samples = work.table("samples").select("tag", "id", "label")

    def statistics() -> DataFrame:
        return keywords.sample_statistics(samples, _texts(work), work.stop_words)[0]

    df = work.table("keyword_df", statistics)
    sizes = samples.groupBy("tag").agg(F.count("*").alias("n"))
    candidates = keywords.candidate_tags(texts, predictions, work.table("tag_histogram"))
    scores = keywords.keyword_scores(texts, candidates, df, sizes, work.stop_words)
    return keywords.with_keyword(predictions, keywords.keywords_of_queries(scores))


def demonstrate(work: Workspace, tag: str, questions: DataFrame, keyword: bool = False) -> DataFrame:
    """The whole way for one tag's sample: its neighbouring tags, its questions and their true tags, suggestions and
    their mean score, all stored under ``demo``; returns the means."""
    sample = work.table("samples").where(F.col("tag") == tag).select("id")
    chosen = work.table("demo_questions", lambda: questions.join(sample.distinct(), "id", "left_semi"))
    candidates = work.table("frequent_tags").select("tag")
    work.table("demo_neighbours", lambda: T.neighbouring_tags(work.table("tagged"), tag, candidates))
    work.table("demo_targets", lambda: chosen.select("id", tag_array(F.col("tags")).alias("target")))
    if not work.has("demo_predictions"):
        sinks.write_predictions(suggest(work, chosen, keyword), work.path("demo_predictions"))
    scores = evaluate.document_f1(work.table("demo_predictions"), work.table("demo_targets"))
    return evaluate.mean_document_f1(work.table("demo_scores", lambda: scores))


def evaluate_suggestions(predictions: DataFrame, questions: DataFrame) -> DataFrame:
    truth = questions.select("id", tag_array(F.col("tags")).alias("target"))
    return evaluate.document_f1(predictions, truth)
