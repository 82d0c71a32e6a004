"""Models, dense features, scoring and evaluation on small data, against plain formulas."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.operators import bayes, evaluate, keywords, lsa, scoring
from labelloom.operators import features as X


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(1)
    rows = []
    for tag, word in (("red", "rose"), ("blue", "sky")):
        for i in range(36):
            label = i % 3 == 0
            words = rng.choices(["stone", "tree", "river", "cloud"], k=4) + ([word] if label or i % 7 == 0 else [])
            rows.append((tag, i, label, (i // 3) % 3, words if i != 35 else []))
    samples = spark.createDataFrame([r[:4] for r in rows], "tag string, id long, label boolean, fold int")
    terms = [(t, i, l, f, w, words.count(w)) for t, i, l, f, words in rows for w in sorted(set(words))]
    return rows, samples, spark.createDataFrame(
        terms, "tag string, id long, label boolean, fold int, term string, tf long"
    )


def log_odds(train, words, vocabulary, alpha, multinomial):
    total = 0.0
    for label, sign in ((True, 1), (False, -1)):
        docs = [w for _, _, l, _, w in train if l == label]
        total += sign * math.log(len(docs))
        if multinomial:
            size = sum(map(len, docs)) + alpha * len(vocabulary)
            total += sign * sum(math.log((sum(d.count(w) for d in docs) + alpha) / size) for w in words)
        else:
            for v in vocabulary:
                p = (sum(v in d for d in docs) + alpha) / (len(docs) + 2 * alpha)
                q = (sum(v not in d for d in docs) + alpha) / (len(docs) + 2 * alpha)
                total += sign * math.log(p if v in words else q)
    return total


@pytest.mark.parametrize("model", ["bernoulli_nb", "multinomial_nb"])
def test_fold_scores_match_formula(training, model):
    rows, samples, terms = training
    found = {
        (r["tag"], r["alpha"], r["fold"]): r["f1"]
        for r in bayes.fold_scores(samples, terms, model, (0.0, 1.0, 2.0)).collect()
    }
    assert len(found) == 18
    for (tag, alpha, fold), f1 in found.items():
        mine = [r for r in rows if r[0] == tag]
        vocabulary = {w for r in mine for w in r[4]}
        train = [r for r in mine if r[3] != fold]
        pairs = [
            (r[2], log_odds(train, r[4], vocabulary, max(alpha, 1e-10), model == "multinomial_nb") > 0)
            for r in mine
            if r[3] == fold
        ]
        hits, misses = sum(a and b for a, b in pairs), sum(a != b for a, b in pairs)
        assert f1 == pytest.approx(2 * hits / (2 * hits + misses) if hits + misses else 0.0)


def test_fitted_models_score_every_document(spark, training):
    rows, samples, terms = training
    best = spark.createDataFrame([("red", 1.0), ("blue", 2.0)], "tag string, alpha double")
    models = bayes.fit(samples, terms, "bernoulli_nb", best)
    texts = [(1, ["rose", "tree", "tree"]), (2, ["sky"]), (3, []), (4, ["unseen"]), (5, ["rose", "sky"])]
    documents = spark.createDataFrame(texts, "id long, terms array<string>")
    found = {r["id"]: r["tags"] for r in scoring.suggest_tags(documents, models).collect()}
    expected = {}
    for i, words in texts:
        expected[i] = []
        for tag, alpha in (("blue", 2.0), ("red", 1.0)):
            mine = [r for r in rows if r[0] == tag]
            vocabulary = {w for r in mine for w in r[4]}
            if log_odds(mine, [w for w in words if w in vocabulary], vocabulary, alpha, False) > 0:
                expected[i].append(tag)
    assert found == expected
    assert any(found.values()) and len(found) == 5


def test_tags_with_positive_bias_reach_documents_without_their_terms(spark):
    models = spark.createDataFrame(
        [("open", "a", -5.0, 1.0), ("shut", "a", 2.0, -1.0)], "tag string, term string, weight double, bias double"
    )
    documents = spark.createDataFrame([(1, ["a"]), (2, ["b"]), (3, [])], "id long, terms array<string>")
    found = {r["id"]: r["tags"] for r in scoring.suggest_tags(documents, models).collect()}
    assert found == {1: ["shut"], 2: ["open"], 3: ["open"]}
    counted = spark.createDataFrame([(1, ["a", "a"]), (2, ["a"])], "id long, terms array<string>")
    twice = models.where("tag = 'shut'").withColumn("bias", F.lit(-3.0))
    found = {r["id"]: r["tags"] for r in scoring.suggest_tags(counted, twice, binary=False).collect()}
    assert found == {1: ["shut"], 2: []}


def test_many_models_in_blocks_and_without_a_shuffle(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    rows = [
        (f"t{t:04d}", w, rng.choice([-1.0, 0.5, 2.0]), -0.75) for t in range(1200) for w in rng.sample(words, 4)
    ]
    models = spark.createDataFrame(rows, "tag string, term string, weight double, bias double")
    texts = [(i, rng.choices(words, k=5)) for i in range(40)] + [(99, [])]
    documents = spark.createDataFrame(texts, "id long, terms array<string>")
    one = scoring.suggest_tags(documents, models)
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    found = {r["id"]: r["tags"] for r in one.collect()}
    blocks = {r["id"]: r["tags"] for r in scoring.suggest_tags(documents, models, block_rows=1000).collect()}
    weight = {(t, w): x for t, w, x, _ in rows}
    tags = sorted({t for t, *_ in rows})
    for i, terms in texts:
        expected = [t for t in tags if sum(weight.get((t, w), 0.0) for w in set(terms)) - 0.75 > 0]
        assert found[i] == expected == blocks[i]


def test_pca_matches_dense(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(f"w{min(int(rng.expovariate(0.2)), 40)}" for _ in range(25))) for i in range(150)]
    rows = X.hashed_rows(spark.createDataFrame(docs, "id long, text string"), (), 32).cache()
    model = lsa.fit_pca(rows, k=4, buckets=32, passes=8)
    local = rows.toPandas()
    counts = np.zeros((len(local), 32))
    for i, (buckets, values) in enumerate(zip(local["buckets"], local["counts"])):
        counts[i, buckets] = values
    dense = counts - counts.mean(axis=0)
    _, values, vectors = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(model.singular_values, values[:4] / math.sqrt(149), rtol=1e-3)
    projected = {r["id"]: r["features"] for r in lsa.project(rows, model).collect()}
    assert np.allclose([abs(projected[i][0]) for i in local["id"]], np.abs(dense @ vectors[0]), atol=1e-3)


def test_lsa_matches_dense_svd(spark):
    rng = random.Random(2)
    docs = [(i, [f"w{min(int(rng.expovariate(0.15)), 60)}" for _ in range(20)]) for i in range(120)] + [(999, [])]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "id long, text string")
    rows = X.hashed_rows(frame, (), 64).cache()
    basis = lsa.fit_lsa(rows, k=5, buckets=64, passes=8)
    local = rows.toPandas()
    counts = np.zeros((len(local), 64))
    for i, (buckets, values) in enumerate(zip(local["buckets"], local["counts"])):
        counts[i, buckets] = values
    weighed = counts * (np.log((1 + 121) / (1 + (counts > 0).sum(axis=0))) + 1)
    norms = np.linalg.norm(weighed, axis=1, keepdims=True)
    dense = weighed / np.where(norms > 0, norms, 1)
    _, values, vectors = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(basis.singular_values, values[:5], rtol=1e-3)
    projected = {r["id"]: r["features"] for r in lsa.project(rows, basis).collect()}
    assert len(projected) == 121 and projected[999] == [0.0] * 5
    expected = np.abs(dense @ vectors[0])
    assert np.allclose([abs(projected[i][0]) for i in local["id"]], expected, atol=1e-3)
    stored = lsa.load_basis(lsa.basis_table(spark, basis))
    assert np.array_equal(stored.vectors, basis.vectors) and np.array_equal(stored.idf, basis.idf)


def test_best_model_breaks_ties_by_order(spark):
    report = spark.createDataFrame(
        [("t", "linear_svc", 0.5), ("t", "bernoulli_nb", 0.5), ("t", "random_forest", 0.4), ("u", "random_forest", 0.1)],
        "tag string, model string, mean_f1 double",
    )
    found = {r["tag"]: r["model"] for r in evaluate.best_model(report).collect()}
    assert found == {"t": "bernoulli_nb", "u": "random_forest"}
    matrix = {r["tag"]: r["linear_svc"] for r in evaluate.score_matrix(report).collect()}
    assert matrix == {"t": 0.5, "u": None}


def test_document_f1(spark):
    predictions = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, ["c"])], "id long, tags array<string>")
    truth = spark.createDataFrame([(1, ["a"]), (2, []), (3, ["a", "c", "d"])], "id long, target array<string>")
    found = {r["id"]: (r["f1"], r["f1_alias_compat"]) for r in evaluate.document_f1(predictions, truth).collect()}
    assert found[1] == (pytest.approx(2 / 3), 1.0)
    assert found[2] == (0.0, 0.0)
    assert found[3] == (0.5, 0.5)
    aligned = {tuple(r) for r in evaluate.align(predictions, truth).collect()}
    assert aligned == {
        (1, "a", True, True),
        (1, "b", False, True),
        (3, "a", True, False),
        (3, "c", True, True),
        (3, "d", True, False),
    }


def test_keyword_is_appended_once(spark):
    predictions = spark.createDataFrame([(1, ["a"]), (2, ["b"]), (3, [])], "id long, tags array<string>")
    ranked = spark.createDataFrame(
        [(1, "k", 0.9, 1), (1, "z", 0.8, 2), (2, "b", 0.7, 1)], "id long, term string, weight double, rank int"
    )
    found = {r["id"]: r["tags"] for r in keywords.with_keyword(predictions, ranked).collect()}
    assert found == {1: ["a", "k"], 2: ["b"], 3: []}
