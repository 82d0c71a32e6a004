"""The choice between families, and documents scored by stored models of all kinds."""

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.operators import boosting, evaluate, families, forest, passes, signs, svm

DIMS, FOLDS = 6, 3


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(1)
    rows = []
    for tag, at in (("high", 0), ("low", 2)):
        for i in range(60):
            x = rng.normal(size=DIMS)
            rows.append((tag, i, bool(x[at] + 0.2 * x[4] > 0.3), i % FOLDS, x.tolist()))
    frame = spark.createDataFrame(rows, "tag string, id long, label boolean, fold int, features array<double>").cache()
    edges = forest.bin_edges(frame)
    reals = passes.row_blocks(frame, 60, FOLDS, block_rows=11).cache()
    return rows, edges, reals, passes.row_blocks(forest.binned(frame, edges), 60, FOLDS, "u1", block_rows=11).cache()


def test_signs_match_the_formula(sample):
    rows, _, reals, _ = sample
    found = signs.fold_scores(reals, signs.fit(reals, reals.select("tag").distinct(), FOLDS, DIMS)).collect()
    assert len(found) == 2 * FOLDS * 3
    for r in found:
        alpha = max(r.alpha, 1e-10)
        train = [(np.array(x) > 0, y) for t, _, y, f, x in rows if t == r.tag and f != r.fold]
        hits = predicted = 0
        for t, _, y, f, x in rows:
            if t == r.tag and f == r.fold:
                odds = 0.0
                for label, side in ((True, 1), (False, -1)):
                    mine = [s for s, l in train if l == label]
                    p = (np.sum(mine, axis=0) + alpha) / (len(mine) + 2 * alpha)
                    q = (len(mine) - np.sum(mine, axis=0) + alpha) / (len(mine) + 2 * alpha)
                    odds += side * (np.log(len(mine)) + np.where(np.array(x) > 0, np.log(p), np.log(q)).sum())
                predicted += odds > 0
                hits += y and odds > 0
        assert (r.hits, r.predicted) == (hits, predicted)


def test_winners_and_ties(spark):
    point = lambda tag, model, f1, **p: (tag, model, *(p.get(k) for k in families.PARAMS), f1)
    schema = "tag string, model string, " + ", ".join(f"{k} {t}" for k, t in families.PARAMS.items()) + ", mean_f1 double"
    rows = [
        point("a", "linear_svc", 0.7, c=10.0),
        point("a", "linear_svc", 0.7, c=1.0),
        point("a", "random_forest", 0.7, impurity="entropy", subset="log2", min_split=2, trees=10),
        point("b", "random_forest", 0.8, impurity="entropy", subset="log2", min_split=2, trees=10),
        point("b", "random_forest", 0.8, impurity="gini", subset="log2", min_split=3, trees=30),
        point("b", "random_forest", 0.8, impurity="gini", subset="log2", min_split=3, trees=20),
        point("b", "gradient_boosting", 0.8 + 1e-15, subset="sqrt", min_split=2, trees=100),
        point("c", "bernoulli_nb", 0.1, alpha=2.0),
        point("c", "gradient_boosting", 0.3, subset="sqrt", min_split=2, trees=100),
    ]
    won = {r.tag: r for r in families.winners(spark.createDataFrame(rows, schema)).collect()}
    assert (won["a"].model, won["a"].c) == ("linear_svc", 1.0)
    assert (won["b"].model, won["b"].impurity, won["b"].trees) == ("random_forest", "gini", 20)
    assert won["c"].model == "gradient_boosting" and len(won) == 3


def test_every_family_is_searched_refitted_and_applied(spark, sample):
    rows, edges, reals, bins = sample
    grids = families.Grids((0.0, 1.0), (1.0, 10.0), (3, 6), ("gini",), ("sqrt", "log2"), (2,), (5, 20))
    scores = families.fold_scores(reals, bins, DIMS, FOLDS, grids)
    assert scores.count() == 2 * FOLDS * grids.points == 2 * FOLDS * (2 + 2 + 4 + 4)
    best = families.best_of_families(families.report(scores))
    assert best.count() == 8 and best.agg(F.min("mean_f1")).first()[0] > 0.5
    matrix = evaluate.score_matrix(best).collect()
    assert len(matrix) == 2 and all(None not in (r.linear_svc, r.random_forest, r.gradient_boosting, r.bernoulli_nb) for r in matrix)
    # Not only the winners: all kinds of the chosen points are fitted and applied, under one name per kind.
    states = families.refit(best, reals, bins, DIMS, FOLDS).collect()
    assert len(states) == 8
    models = spark.createDataFrame([(f"{r.tag}/{r.model}", r.model, bytes(r.state)) for r in states], "tag string, model string, state binary")
    x = np.array([x for t, _, _, _, x in rows if t == "high"])
    documents = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    documents = forest.binned(documents, edges, "bins")
    found = {r.id: r.tags for r in families.suggest(documents, models).collect()}
    b = np.array([r.bins for r in documents.orderBy("id").collect()])
    held = {f"{r.tag}/{r.model}": pickle.loads(r.state) for r in states}
    for i in range(len(x)):
        assert found[i] == [t for t in sorted(held) if held[t].accepts(x[i : i + 1], b[i : i + 1])[0]]
    truth = {i for t, i, y, _, _ in rows if t == "high" and y}
    assert len(truth ^ {i for i in found if "high/linear_svc" in found[i]}) < 8


def mixed_models(rng):
    """1200 small models of four kinds, fitted or made up."""
    states = []
    x, y = rng.normal(size=(40, DIMS)), rng.random(40) < 0.4
    bins = rng.integers(0, 8, (40, DIMS)).astype(np.uint8)
    for i in range(300):
        one = svm.first_state(-1, (1.0,), DIMS)
        one.w = rng.normal(size=(1, DIMS + 1))
        states.append(one)
        two = signs.Counts(rng.integers(1, 9, (FOLDS, 2, DIMS + 1)).astype(float))
        two.counts[:, :, -1] = 9
        states.append(two)
        three = forest.planted({"fold": -1, "impurity": "gini", "subset": "sqrt", "min_split": 2, "trees": 3, "dims": DIMS})
        states.append(forest.step(three, forest.measure(passes.Block(0, np.arange(40) + i, y, bins), three))[0])
        states.append(boosting.boost(bins, np.roll(y, i), -1, "sqrt", 2, 2))
    return states


def test_1200_mixed_models_in_files(spark):
    rng = np.random.default_rng(8)
    states = mixed_models(rng)
    rows = [(f"t{i:04d}", type(s).__name__, pickle.dumps(s)) for i, s in enumerate(states)]
    models = spark.createDataFrame(rows, "tag string, model string, state binary").repartition(4)
    x, b = rng.normal(size=(30, DIMS)), rng.integers(0, 8, (30, DIMS))
    documents = spark.createDataFrame([(i, x[i].tolist(), b[i].tolist()) for i in range(30)], "id long, features array<double>, bins array<int>")
    expected = [[t for t, s in zip((r[0] for r in rows), states) if s.accepts(x[i : i + 1], b[i : i + 1])[0]] for i in range(30)]
    files = families.model_files(models, 200_000).groupBy("file").agg(F.sum(F.octet_length("state")).alias("bytes")).collect()
    assert len(files) > 3 and max(f.bytes for f in files) < 220_000
    for most, group in ((families.FILE_BYTES, 20_000), (200_000, 7)):
        suggested = families.suggest(documents, models, most, group)
        plan = suggested._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "CartesianProduct" not in plan and len(plan) < 20_000
        assert {r.id: r.tags for r in suggested.collect()} == dict(enumerate(expected))
    assert any(expected)


def test_no_models(spark):
    documents = spark.createDataFrame([(1, [0.5], [3])], "id long, features array<double>, bins array<int>")
    models = spark.createDataFrame([], "tag string, model string, state binary")
    assert [tuple(r) for r in families.suggest(documents, models).collect()] == [(1, [])]
