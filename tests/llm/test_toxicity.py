"""Folding, matching, counting and scoring of the toxicity lexicon."""

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from labelloom.llm import toxicity as t
from labelloom.llm.common import documents, table
from labelloom.llm.queries import QUERIES
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string, score string, hits int, lang string"
FOLDER = "/root/testdata/sf0.01"


def test_folding():
    same = ["You 1D10T!", "you ＩＤＩＯＴ", "y​ou... іdіоt", "YOU, id!ot", "you idlot"]
    assert {t.fold(x) for x in same} == {" you  idiot "}
    assert t.fold("tr@sh $tupid cl0wn") == " trash  stupid  ciown "
    assert t.fold("ndreea$$$ 2019 %%% a@b") == " ndreea  2019  aab "
    assert t.fold("") == t.fold(" \n?! ") == "" and t.fold("ééé") == " ééé "


def plain_matches(folded, weights, phrases):
    """Leftmost longest matches by trying every pattern at every place."""
    at, found = 0, []
    patterns = sorted([*weights, *phrases], key=len, reverse=True)
    while at < len(folded):
        hit = next((p for p in patterns if folded.startswith(p, at)), None)
        if hit in weights:
            found.append((at, weights[hit]))
        at += len(hit) if hit else 1
    return found


def test_matches_equal_trying_every_pattern():
    rng = random.Random(5)
    words = ["trash", "trashy", "can", "scum", "lowly", "lowei", "a", "bag", "scumbag", "idiot"]
    weights = {t.fold(w) if rng.random() < 0.5 else t.fold(w)[:-1]: i + 1.5 for i, w in enumerate(["trash", "scum", "lowe", "idiot", "scumb"])}
    phrases = tuple(t.fold(p) for p in ("trash can", "can trash", "scum bag"))
    automaton = t.Model(weights, phrases).automaton()
    for _ in range(300):
        folded = t.fold(" ".join(rng.choices(words, k=rng.randrange(12))))
        assert list(t.matches(folded, automaton)) == plain_matches(folded, weights, phrases)


def test_counts_and_weights_equal_plain_ones(spark):
    rng = random.Random(8)
    rows = [(rng.random() < 0.4, t.fold(prose(rng, 30) + (" moron vexling" if rng.random() < 0.5 else ""))) for _ in range(80)]
    rows += [(True, t.fold(f"vex{x} {prose(rng, 5)}")) for x in ("a", "bo", "cu", "di", "e", "fo", "gum", "hu")] + [(True, "")]
    sample = spark.createDataFrame(rows, "toxic boolean, folded string").repartition(3)
    bad, good = Counter(), Counter()
    for toxic, folded in rows:
        for word in set(folded.split()):
            (bad if toxic else good).update(t.entries_of(word))
    words = t.counted(sample, lambda folded: set(folded.split()))
    assert {r.thing: (r.bad, r.good) for r in words.collect()} == {
        w[1:-1]: (bad[w], good[w]) for w in bad | good if w.endswith(" ")
    }
    weights = t.lexicon(sample)
    n_bad, n_good = (sum(c for w, c in x.items() if w.endswith(" ")) for x in (bad, good))
    for entry, weight in weights.items():
        longer = [e for e in weights if e != entry and e.startswith(entry)]
        if not longer:
            assert abs(weight - t.odds(bad[entry], good[entry], n_bad, n_good)) < 1e-12


def labelled(rng, n):
    """Documents of which a third are toxic: by a word in many disguises; clean ones may speak of trash cans."""
    disguises = ["trash", "TRASH!", "tr@sh", "trа5h", "7rash"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        words = prose(rng, rng.randrange(5, 80)).split()
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(disguises))
        elif i % 15 == 1:
            words.insert(rng.randrange(len(words)), "trash basket")
        elif i % 15 == 2:
            words.insert(rng.randrange(len(words)), "trash can")
        rows.append((i, " ".join(words), "clash", 7, "en"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_disguises_exceptions_and_awkward_rows(spark):
    rows, labels = labelled(random.Random(2), 400)
    odd = [(None, "you trash", "x", 1, "en"), (5000, None, "x", 1, None), (5001, "", "x", 1, None), (5002, "?!", "x", 1, None)]
    odd += [(5003, "word " * 50_000 + "trash", "x", 1, "en"), (5004, "trash " * 3, "x", 1, "en"), (5004, "trash " * 3, "x", 1, "en")]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(3)
    marks = spark.createDataFrame([*labels, (5001, 1, None), (None, 0, 1), (0, 1, 0), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    model = t.fit(docs, marks)
    assert " trash " in model.weights and " trash  basket " in model.exceptions and " trash  can " in model.exceptions
    scored = t.score(docs, model)
    assert scored.columns == ["doc_id", "text", "score", "hits", "lang", "score_", "hits_"]
    found = scored.collect()
    assert len(found) == len(rows) + len(odd)
    truth = {i: y for i, _, y in labels}
    assert all((r.score_ >= t.FLAGGED) == truth[r.doc_id] for r in found if r.doc_id in truth)
    empty = {r.score_ for r in found if r.doc_id in (5000, 5001, 5002)}
    assert len(empty) == 1 and 0 <= empty.pop() < t.FLAGGED
    assert {r.score_ for r in found if r.doc_id is None}.pop() >= t.FLAGGED
    assert len({r.score_ for r in found if r.doc_id == 5004}) == 1
    assert all(0 <= r.score_ <= 1 for r in found)


def test_held_out_labels_are_never_read(spark):
    rows, labels = labelled(random.Random(3), 200)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(i, q, 1 - y) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, y) for i, q, y in labels]
    models = [t.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned)]
    assert models[0] == models[1]
    held = spark.range(300).select("id", t.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in held)


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "some trash", "x", 1, "en")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = t.fit(docs, none)
    assert not model.weights and [r.score_ for r in t.score(docs, model).collect()] == [0.0]
    one_kind = t.fit(docs, spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int"))
    assert not one_kind.weights and one_kind.prior == 1.0
    assert t.score(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_held_out_documents_of_the_given_tables(spark):
    found = {r.doc_id: r for r in QUERIES["op11_toxicity"](spark, FOLDER).collect()}
    assert len(found) == documents(spark, FOLDER).count()
    truth = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    held = [(truth[i], r.predicted) for i, r in found.items() if r.held_out and i in truth]
    right = sum(a and b for a, b in held)
    assert 2 * right / (sum(a for a, _ in held) + sum(b for _, b in held)) > 0.8
