"""Readers, writers and the end-to-end jobs."""

import pytest
from pyspark.sql import functions as F

from labelloom.operators import clean, families
from labelloom.operators import tags as T
from labelloom.operators.sampling import SampleSpec
from labelloom.plans import jobs
from labelloom import session
from labelloom.session import shared_dir
from labelloom.sources import questions as Q
from labelloom.sources import sinks

CSV = '''Id,Title,Body,Tags
1,"A ""quoted"" title","<p>first
line</p>
<pre><code>x = ""1""
</code></pre>
",python  html
2,Empty body,,
3,Back\\slash,"<p>a, b</p>",c
'''


def test_question_csv(spark, tmp_path):
    (tmp_path / "q.csv").write_text(CSV)
    rows = {r["id"]: r for r in Q.read_questions_csv(spark, str(tmp_path / "q.csv")).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1]["title"] == 'A "quoted" title'
    assert rows[1]["body"] == '<p>first\nline</p>\n<pre><code>x = "1"\n</code></pre>\n'
    assert rows[2]["body"] == "" and rows[2]["tags"] == ""
    assert rows[3]["title"] == "Back\\slash"


def test_stop_words(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\n of \n\nthe\n")
    words = Q.load_stop_words(spark, str(tmp_path / "stop.txt"))
    assert sorted(r["word"] for r in words.collect()) == ["of", "the"]
    terms = spark.createDataFrame([(1, ["the", "sun", "the", "sun"]), (2, ["of"])], "id long, terms array<string>")
    assert sorted(map(tuple, clean.without_stop_words(terms, words).collect())) == [(1, "sun"), (1, "sun")]


def test_latest_row_of_an_id(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, None)], "id long, n long, body string")
    assert sorted(map(tuple, Q.latest_by_id(rows, "n").collect())) == [(1, "c"), (2, None)]


def test_samples_of_one_tag_read_one_folder(spark, tmp_path):
    rows = [(i, "t", "b", [], i % 2 == 0, tag) for i in range(6) for tag in ("c++", "c#")]
    frame = spark.createDataFrame(rows, sinks.SAMPLE_SCHEMA)
    for _ in range(2):
        sinks.write_samples(frame, str(tmp_path / "s"), files_per_tag=2)
    one = sinks.read_samples(spark, str(tmp_path / "s"), "c++")
    assert one.count() == 6 and one.agg(F.sum("target")).first()[0] == 3.0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tag" in plan


def test_important_records(spark):
    questions = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "b c"), (4, "")], "id long, tags string")
    selected = spark.createDataFrame([("a",), ("b",)], "tag string")
    found = T.important_records(questions, selected).collect()
    assert sorted(r["id"] for r in found) == [1, 3]


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    rows = spark.range(600).select(
        "id",
        F.concat(F.lit("title "), "id").alias("title"),
        F.concat(
            F.lit("<p>common words "),
            F.when(F.col("id") % 3 == 0, "snake indent").otherwise("curly brace"),
            F.lit("</p><pre>hidden code</pre> <p>more"),
            F.col("id") % 5,
            F.lit("</p>"),
        ).alias("body"),
        F.when(F.col("id") % 3 == 0, "python").otherwise("java").alias("tags"),
    )
    spec = SampleSpec(positives=30, negatives=60, more_than=100)
    space = jobs.Workspace(spark, str(tmp_path_factory.mktemp("work")), spec, ["common"])
    jobs.prepare(space, rows)
    return space, rows


def test_prepare_and_suggest(work):
    space, rows = work
    assert space.table("samples").count() == 180
    assert sinks.read_samples(space.spark, space.path("sample_files"), "java").count() == 90
    assert space.table("inverted_index").count() == 600
    jobs.survey_bayes(space)
    questions = rows.where("id < 60")
    scores = jobs.evaluate_suggestions(jobs.suggest(space, questions), questions)
    row = scores.agg(F.count("*"), F.avg("f1")).first()
    assert row[0] == 60 and row[1] == 1.0
    with_keyword = jobs.suggest(space, questions, keyword=True)
    assert with_keyword.count() == 60 and with_keyword.where(F.size("tags") != 2).count() == 0


def test_demonstration(work):
    space, rows = work
    jobs.survey_bayes(space)
    means = jobs.demonstrate(space, "java", rows).first()
    assert means["documents"] == 90 and means["mean_f1"] == 1.0
    assert space.table("demo_predictions").count() == 90 == space.table("demo_targets").count()
    assert [r["tag"] for r in space.table("demo_neighbours").collect()] == ["java"]


def test_other_parameters_have_other_tables(work):
    space, _ = work
    other = jobs.Workspace(space.spark, space.home, space.spec, ["other"])
    assert other.path("samples") != space.path("samples") and not other.has("samples")


def test_winners_of_all_families_suggest(work, monkeypatch):
    space, rows = work
    few = families.Grids((1.0,), (1.0, 100.0), (5,), ("gini",), ("sqrt",), (2,), (10,))
    best = jobs.survey_families(space, few, components=6)
    assert sorted({(r["tag"], r["model"]) for r in best.collect()}) == [(t, m) for t in ("java", "python") for m in sorted(few.families)]
    assert space.table("winners").count() == space.table("winner_models").count() == 2
    assert space.spark.read.csv(space.path("family_matrix"), header=True).count() == 2
    monkeypatch.setattr(families, "fold_scores", None)  # a second run finds every table
    assert jobs.survey_families(space, few, components=6).count() == 8
    questions = rows.where("id < 30")
    scores = jobs.evaluate_suggestions(jobs.suggest(space, questions), questions)
    assert scores.count() == 30 and scores.agg(F.avg("f1")).first()[0] > 0.8


def test_stages_are_deleted(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    assert session.stage(spark.range(3), "three").count() == 3
    assert session.delete_stages(spark) == 1 and session.delete_stages(spark) == 0


class _Session:
    """Only what ``shared_dir`` asks of a session."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})


def test_shared_folder():
    assert shared_dir(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(_Session("local[2]")) == shared_dir(_Session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn"))
