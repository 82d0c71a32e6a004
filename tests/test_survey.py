"""The trained families fitted in shared passes, against plain restatements on small samples."""

import math
import pickle

import numpy as np
import pytest

from labelloom.operators import boosting, forest, passes, svm

TAGS, FOLDS, DIMS = ("red", "blue", "none"), 3, 7


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for tag in TAGS:
        for i in range(45):
            x = rng.integers(0, 6, DIMS)
            noise = rng.random() < 0.2
            label = tag != "none" and bool((x[0] + x[3] > 5) ^ noise)
            out.append((tag, 3 * i + 1, label, i % FOLDS, x.tolist()))
    return out


@pytest.fixture(scope="module")
def blocks(spark, rows):
    frame = spark.createDataFrame(rows, "tag string, id long, label boolean, fold int, features array<int>").repartition(5)
    doubles = frame.selectExpr("tag", "id", "label", "fold", "transform(features, x -> x / 5D) AS features")
    # Some blocks of a few rows: sums over blocks must not depend on the cut.
    return passes.row_blocks(frame, 45, FOLDS, "u1", block_rows=8).cache(), passes.row_blocks(doubles, 45, FOLDS, block_rows=8).cache()


def states_of(frame):
    return {(r.tag, r.job): pickle.loads(r.state) for r in frame.collect()}


def part_of(rows, tag, fold, left_out):
    mine = sorted((r for r in rows if r[0] == tag and (r[3] == fold) == left_out), key=lambda r: r[1])
    return np.array([r[1] for r in mine]), np.array([r[4] for r in mine]), np.array([r[2] for r in mine], dtype=bool)


def test_blocks_hold_every_row_once(rows, blocks):
    assert all(len(pickle.loads(r.data).ids) < 15 for r in blocks[0].collect())
    found = []
    for r in blocks[0].collect():
        b = pickle.loads(r.data)
        found += [(r.tag, int(i), bool(l), r.fold, x.tolist()) for i, l, x in zip(b.ids, b.label, b.x)]
    assert sorted(found) == sorted(rows)


def test_svm_reaches_the_minimum_and_scores_left_out_folds(spark, rows, blocks):
    tags = blocks[1].select("tag").distinct()
    found = svm.fit(blocks[1], svm.grid(tags, FOLDS, (0.1, 1e4)), DIMS)
    states = states_of(found)
    assert len(states) == len(TAGS) * FOLDS
    for (tag, job), s in states.items():
        _, x, label = part_of(rows, tag, int(job), False)
        x, y = np.column_stack([x / 5, np.ones(len(x))]), np.where(label, 1.0, -1.0)

        def loss(w, c):
            return 0.5 * w @ w + c * (np.maximum(1 - y * (x @ w), 0) ** 2).sum()

        assert s.done.all() and s.passes <= 100
        for c, w in zip(s.c, s.w):
            gradient = w - 2 * c * ((np.maximum(1 - y * (x @ w), 0) * y) @ x)
            start = 2 * c * np.abs(y @ x).sum()
            assert np.sqrt(gradient @ gradient) <= 1e-5 * max(start, 1)
            rng = np.random.default_rng(0)
            assert all(loss(w, c) <= loss(w + rng.normal(0, 1e-3, len(w)), c) + 1e-9 for _ in range(20))
    for r in svm.fold_scores(blocks[1], found).collect():
        _, x, label = part_of(rows, r.tag, r.fold, True)
        s = states[r.tag, str(r.fold)]
        p = np.column_stack([x / 5, np.ones(len(x))]) @ s.w[s.c.tolist().index(r.c)] > 0
        assert (r.n, r.positives, r.hits, r.predicted) == (len(x), label.sum(), (p & label).sum(), p.sum())
        assert r.f1 == pytest.approx(2 * r.hits / (r.positives + r.predicted) if r.positives + r.predicted else 0.0)
    assert svm.models(found).where("tag = 'none' AND bias < 0").count() == 6


def plain_tree(ids, x, label, tree, times, setting, max_depth):
    """``{node: (feature, bin) or share}`` by recursion."""
    impurity, k, min_split = setting
    out = {}

    def grow(node, mine):
        weight = times[mine, tree]
        pos, all_ = int((weight * label[mine]).sum()), int(weight.sum())
        out[node] = pos / all_ if all_ else 0.0
        if not 0 < pos < all_ or len(mine) < min_split or math.floor(math.log2(node)) >= max_depth:
            return
        best = None
        for f in forest.candidates(np.array([tree]), np.array([node]), x.shape[1], k)[0]:
            for cut in range(forest.BINS - 1):
                sides = []
                for side in (mine[x[mine, f] <= cut], mine[x[mine, f] > cut]):
                    sides.append(np.array([(times[side, tree] * ~label[side]).sum(), (times[side, tree] * label[side]).sum()], float))
                if min(s.sum() for s in sides) > 0:
                    value = float(forest.gain(sides[0], sides[1], impurity))
                    if best is None or value > best[0]:
                        best = (value, int(f), cut)
        if best:
            out[node] = best[1:]
            grow(2 * node, mine[x[mine, best[1]] <= best[2]])
            grow(2 * node + 1, mine[x[mine, best[1]] > best[2]])

    grow(1, np.flatnonzero(times[:, tree]))
    return out


def test_forests_equal_trees_grown_row_by_row(rows, blocks):
    tags = blocks[0].select("tag").distinct()
    found = forest.fit(blocks[0], forest.grid(tags, FOLDS, DIMS, trees=4, min_split=(2, 6)), max_depth=5)
    states = states_of(found)
    assert len(states) == len(TAGS) * FOLDS * 8
    for (tag, _), s in states.items():
        ids, x, label = part_of(rows, tag, s.fold, False)
        times = forest.bootstrap(ids, 4)
        for t in range(4):
            mine = np.flatnonzero(s.tree == t)
            grown = {int(s.node[i]): (int(s.feature[i]), int(s.bin[i])) if s.feature[i] >= 0 else s.share[i] for i in mine}
            plain = plain_tree(ids, x, label, t, times, (s.impurity, s.k, s.min_split), 5)
            assert grown.keys() == plain.keys() and all(grown[n] == pytest.approx(plain[n]) for n in plain)
    for r in forest.fold_scores(blocks[0], found, (1, 3)).collect():
        s = next(s for (tag, _), s in states.items() if (tag, s.impurity, s.subset, s.min_split, s.fold) == (r.tag, r.impurity, r.subset, r.min_split, r.fold))
        _, x, label = part_of(rows, r.tag, r.fold, True)
        p = forest.shares(s, x)[:, : r.trees].mean(axis=1) > 0.5
        assert (r.n, r.positives, r.hits, r.predicted) == (len(x), label.sum(), (p & label).sum(), p.sum())


def test_bootstrap_and_candidates_look_random():
    times = forest.bootstrap(np.arange(4000), 30)
    assert abs(times.mean() - 1) < 0.02 and abs((times == 0).mean() - math.exp(-1)) < 0.01
    assert abs(np.corrcoef(times[:, 0], times[:, 1])[0, 1]) < 0.06
    chosen = forest.candidates(np.repeat(np.arange(30), 50), np.tile(np.arange(1, 51), 30), 64, 8)
    assert (np.diff(chosen, axis=1) > 0).all()
    assert np.bincount(chosen.ravel(), minlength=64).min() > 100


def plain_boost(x, label, subset, min_split, trees):
    """Trees by recursion over rows, as nested dicts, and the margin of any row."""
    share = label.mean()
    start = math.log(share / (1 - share))
    margin, grown = np.full(len(x), start), []
    k = forest.subset_size(subset, x.shape[1])
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        residual = label - p
        tree = {}

        def grow(node, mine):
            best = None
            if node < 8 and len(mine) >= min_split:
                for f in forest.candidates(np.array([t]), np.array([node]), x.shape[1], k)[0]:
                    for cut in range(forest.BINS - 1):
                        side = x[mine, f] <= cut
                        if 0 < side.sum() < len(mine):
                            a, b = residual[mine[side]], residual[mine[~side]]
                            value = round(a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b), 6)
                            if best is None or value > best[0]:
                                best = (value, int(f), cut)
            if best:
                tree[node] = best[1:]
                grow(2 * node, mine[x[mine, best[1]] <= best[2]])
                grow(2 * node + 1, mine[x[mine, best[1]] > best[2]])
            else:
                tree[node] = residual[mine].sum() / (p[mine] * (1 - p[mine])).sum()
                margin[mine] += boosting.RATE * tree[node]

        grow(1, np.arange(len(x)))
        grown.append(tree)
    return start, grown


def test_boosting_equals_trees_grown_row_by_row(rows, blocks):
    tags = blocks[0].select("tag").distinct()
    found = boosting.fit(blocks[0], boosting.grid(tags, FOLDS, min_split=(2, 12)), trees=6)
    states = states_of(found)
    assert len(states) == len(TAGS) * FOLDS * 4
    margins = {}
    for (tag, job), s in states.items():
        _, left_out, _ = part_of(rows, tag, s.fold, True)
        ours = s.margins(left_out, (2, 6))
        if tag == "none":
            assert (ours < -20).all() and (s.feature < 0).all()
            continue
        _, x, label = part_of(rows, tag, s.fold, False)
        start, grown = plain_boost(x, label, s.subset, s.min_split, 6)
        for row, values in zip(left_out, ours):
            total, at_size = start, []
            for tree in grown:
                node = 1
                while isinstance(tree[node], tuple):
                    node = 2 * node + int(row[tree[node][0]] > tree[node][1])
                total += boosting.RATE * tree[node]
                at_size.append(total)
            assert values == pytest.approx([at_size[1], at_size[5]])
        margins[tag, job] = ours
    for r in boosting.fold_scores(blocks[0], found, (2, 6)).collect():
        _, x, label = part_of(rows, r.tag, r.fold, True)
        p = states[r.tag, f"{r.subset}:{r.min_split}:{r.fold}"].margins(x, (2, 6))[:, (2, 6).index(r.trees)] > 0
        assert (r.n, r.positives, r.hits, r.predicted) == (len(x), label.sum(), (p & label).sum(), p.sum())
