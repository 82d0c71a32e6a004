"""The language model and the quality classifier."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from labelloom.llm import cotrain, gru
from tests.llm.conftest import SCHEMA, prose

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER)) + [gru.END]


def test_base_scores_and_counts(docs, doc_rows):
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    counts = collections.Counter(t for d, text, *_ in doc_rows if not held(d) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = gru.score(docs).collect()
    assert len(out) == len(doc_rows)
    by_id = {r[0]: r[1] for r in doc_rows}
    for r in out:
        t = tokens(by_id[r.doc_id])
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in t)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(t), total)
        assert r.n_known == sum(counts[x] > 0 for x in t)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert gru.score(docs.limit(0)).count() == 0


def small_vocabulary(words):
    counts = collections.Counter(words)
    chosen = sorted([*counts, gru.END], key=lambda w: (-counts[w], w))
    group = np.minimum(np.arange(len(chosen)) * 3 // len(chosen), 2)
    return gru.Vocabulary(
        dict(counts), {w: i for i, w in enumerate(chosen)}, np.append(group, 3), np.searchsorted(group, np.arange(4)),
        np.array([counts[w] for w in chosen] + [1.0]), 100, len(chosen), 1, 1,
    )


def test_gradients_match_differences():
    v = small_vocabulary("a a a b b c d e f g".split())
    rng = np.random.default_rng(3)
    p = {k: (w + 0.3 * rng.standard_normal(w.shape)).astype(np.float64) for k, w in gru.new_parameters(v, 5).items()}
    entries, bounds = rng.integers(0, len(v.entry) + 1, 17), np.array([0, 6, 6, 13, 17])
    x, y, fresh, _, active = gru.lanes(entries, bounds, v.entry[gru.END], 2)

    def loss(q):
        h = np.zeros((x.shape[1], 5), np.float64)
        _, _, total, n = gru.window_gradients(q, v, h, x, y, fresh, active)
        return total / n

    grads = gru.window_gradients(p, v, np.zeros((x.shape[1], 5)), x, y, fresh, active)[0]
    for name, w in p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            up, down = ({k: u.copy() for k, u in p.items()} for _ in range(2))
            up[name][at] += 1e-3
            down[name][at] -= 1e-3
            assert abs((loss(up) - loss(down)) / 2e-3 - grads[name][at]) < 2e-3, name


def test_probabilities_sum_to_one_and_state_is_carried():
    v = small_vocabulary("a a a b b c d e f g".split())
    p = gru.new_parameters(v, 6)
    states = np.random.default_rng(4).standard_normal((1, 6)).astype(np.float32)
    every = np.arange(len(v.entry) + 1)
    logs = gru.word_log_probabilities(p, v, np.repeat(states, len(every), axis=0), every)[0]
    assert abs(np.exp(logs).sum() - 1) < 1e-5
    entries = np.random.default_rng(5).integers(0, len(v.entry) + 1, 300)
    alone = gru.document_scores(p, v, entries, np.array([0, 300]), 1)
    together = gru.document_scores(p, v, np.concatenate([entries, entries[:40]]), np.array([0, 300, 340]), 2)
    assert np.allclose(alone[0], together[0], rtol=1e-5)  # many windows, alone or beside a shorter lane
    h = np.zeros((1, 6), np.float32)
    x = np.concatenate([[v.entry[gru.END]], entries])[:, None]
    fresh = np.arange(301)[:, None] == 0
    whole, _ = gru.run_window(p, h, x, fresh, np.ones(301, dtype=int))
    target = np.append(entries, v.entry[gru.END])
    assert np.isclose(gru.word_log_probabilities(p, v, whole[:, 0], target)[0].sum(), alone[0], rtol=1e-4)


def test_training_beats_the_unigram_start():
    rng = random.Random(6)
    sentences = [" ".join(rng.choice(["red green blue", "one two three four"]) for _ in range(30)) for _ in range(40)]
    v = small_vocabulary(" ".join(sentences).split())
    distinct, places, bounds = gru.split_tokens(pa.array(sentences, pa.large_string()))
    piece = gru.entries_of(v, distinct)[places], bounds
    p = gru.new_parameters(v)
    before = gru.document_scores(p, v, *piece).sum()
    for _ in range(4):
        p = gru.train_on(p, v, [piece])[0]
    assert gru.document_scores(p, v, *piece).sum() > 0.6 * before


def test_every_training_document_is_learned_from(spark, monkeypatch):
    rows = [(i, f"text {i}") for i in range(200)] + [(None, "text null"), (None, None), (3, "text 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    v = gru.vocabulary(gru.word_counts(docs))
    made, whole = [], gru.stage

    def kept(df, name):
        made.append(whole(df, name))
        return made[-1]

    monkeypatch.setattr(gru, "stage", kept)
    gru.train(docs, v)
    trained = [r for r in rows if not gru.is_held_out(r[0])]
    assert sum(r.seen for df in made for r in df.collect()) == sum(len(tokens(t)) for _, t in trained) == v.total


def test_held_out_quality(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(1600):
        text, kind = prose(rng, rng.randrange(20, 80)), i % 8
        if kind == 1:
            text = text.replace(" ", "!! ").upper()
        if kind == 2:
            w = text.split()
            w[rng.randrange(len(w))] = rng.choice(["scoundrel", "vermin"])
            w[rng.randrange(len(w))] = rng.choice(["scoundrel", "vermin"])
            text = " ".join(w)
        rows.append((i, text, rng.choice(["en", "de"]), f"src{i % 3}", len(text), "clash", 1))
        if i < 1200:
            labels.append((i, int(kind != 1), int(kind == 2)))
    labels += [(None, 1, 0), (1500, None, 0), (0, 1, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = cotrain.fit(docs, known)
    kept = {r.doc_id: r.p_good >= 0.5 for r in cotrain.score(docs, model).collect()}
    right = [kept[i] == (i % 8 not in (1, 2)) for i in range(1200, 1600)]
    assert sum(right) / len(right) > 0.97
    assert cotrain.fit(docs, known.where("quality = 1 AND toxic = 0")) is None
    assert cotrain.fit(docs.limit(0), known) is None


def test_awkward_rows_are_scored(docs, doc_rows):
    out = cotrain.score(docs, None, add="p_good_").collect()
    assert len(out) == len(doc_rows) and {r.p_good_ for r in out} == {0.5} and {r.spans for r in out} == {"clash", None}
    assert cotrain.score(docs.limit(0), None).count() == 0
