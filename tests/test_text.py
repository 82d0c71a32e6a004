"""HTML cleaning and token functions on small hand-made texts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.functions import text as T
from labelloom.operators.clean import clean_questions

CASES = [
    ("", "", []),
    ("plain", "", []),
    (None, "", []),
    ("<pre><code>x</code></pre>y<b>", "xy", []),
    ("hi <code>c1</code> mid <pre><code>c2\n</code></pre>\n<p>z</p> tail", "hi mid z", ["c1", "c2\n"]),
    ("<p>a > b</p>q<i>", "bq", []),
    ("a<pre>\n<code>x</code>w<p>", "axw", ["\n"]),
    ("<p><code>k</code> z</p>", "k z", []),
    ("a<code>b<code>c<code>d<code>e<code>", "ace", ["b", "d"]),
    ('a<code class="x">b</code>', "ab", []),
    ("a<CODE>b</CODE>", "ab", []),
    ("x &gt; y<p>", "x &gt; y", []),
    ("1 < 2 <b>\t\x0b\f\r\nz <i>", "1 < 2 z", []),
]


def clean(spark, bodies):
    rows = [(i, "t", body, "") for i, body in enumerate(bodies)]
    frame = spark.createDataFrame(rows, "id long, title string, body string, tags string")
    return [(r["body"], r["code"]) for r in clean_questions(frame).orderBy("id").collect()]


def test_html_cases(spark):
    assert clean(spark, [c[0] for c in CASES]) == [(c[1], c[2]) for c in CASES]


def stepwise(body):
    """The cleaning rules as a scan with a flag, for comparison."""
    prose, code, pending, at = [], [], False, 0
    for mark in re.finditer("<[^<]*>", body):
        piece, at = body[at : mark.start()], mark.end()
        if not piece:
            continue
        (code if pending else prose).append(piece)
        pending = not pending and mark.group() in ("<code>", "<pre>")
    return re.sub("[ \t\n\r\x0b\f]+", " ", "".join(prose)).strip(" "), code


def test_html_random(spark):
    rng = random.Random(5)
    parts = ["<code>", "<pre>", "</code>", "</pre>", "<p>", "a", " b ", "\n", "<", ">", "x<y", "&lt;"]
    bodies = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(400)]
    assert clean(spark, bodies) == [stepwise(b) for b in bodies]


def test_tokens_and_pairs(spark):
    row = spark.range(1).select(
        T.tokens(F.lit("The É2 a C_3 the, état-x")).alias("words"),
        T.without_words(T.tokens(F.lit("the big The dog")), ["the"]).alias("kept"),
        T.with_bigrams(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("pairs"),
        T.with_bigrams(F.array(F.lit("a"))).alias("one"),
        T.with_bigrams(F.array().cast("array<string>")).alias("none"),
        T.tag_array(F.lit("  x  y\tz ")).alias("tags"),
        T.model_text(F.lit("a"), F.lit(None)).alias("text"),
        T.model_text(F.lit("a"), F.lit("b"), sep="").alias("glued"),
    ).first()
    assert row["words"] == ["the", "é2", "c_3", "the", "état"]
    assert row["kept"] == ["big", "dog"]
    assert row["pairs"] == ["a", "b", "c", "a b", "b c"]
    assert row["one"] == ["a"] and row["none"] == []
    assert row["tags"] == ["x", "y", "z"]
    assert row["text"] == "a " and row["glued"] == "ab"


@pytest.mark.parametrize("seed", range(3))
def test_term_runs(spark, seed):
    rng = random.Random(seed)
    docs = [(i, rng.choices("abcde", k=rng.randrange(12))) for i in range(50)] + [(99, [])]
    frame = spark.createDataFrame(docs, "id long, w array<string>")
    found = {(r["id"], r["term"]): r["tf"] for r in T.count_terms(frame, "w").collect()}
    assert found == {(i, t): n for i, words in docs for t, n in Counter(words).items()}
