"""Tiling, fingerprints and near-duplicates against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from labelloom.llm import oneperm, probminhash, tiling
from tests.llm.conftest import prose


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(text):
    w = words(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def jaccard(a, b):
    return len(a.keys() & b.keys()) / len(a.keys() | b.keys()) if a or b else 1.0


def weighted_jaccard(a, b):
    return (a & b).total() / (a | b).total()


def prob_jaccard(a, b):
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in every) for d in a.keys() & b.keys())


# -- greedy string tiling --


def slow_tiles(a, b, least):
    a, b, out = list(a), list(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] is not None and a[i + k] == b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return out
        k, i, j = best
        out.append(k)
        a[i : i + k], b[j : j + k] = [None] * k, [None] * k


def test_tiles_match_slow_search():
    rng = np.random.default_rng(1)
    for _ in range(40):
        item = rng.integers(1, 6, rng.integers(1, 30)).astype(np.uint64)
        doc = rng.integers(1, 6, rng.integers(0, 60)).astype(np.uint64)
        found = tiling.tiles(item, doc, 3)
        least = min(3, len(item))
        assert [f[0] for f in found][:1] == slow_tiles(item, doc, least)[:1]
        for size, i, j in found:
            assert np.array_equal(item[i : i + size], doc[j : j + size])
        for side in (1, 2):
            marked = [x for f in found for x in range(f[side], f[side] + f[0])]
            assert len(marked) == len(set(marked))
        left = slow_tiles([None if k in {x for f in found for x in range(f[1], f[1] + f[0])} else v for k, v in enumerate(item)],
                          [None if k in {x for f in found for x in range(f[2], f[2] + f[0])} else v for k, v in enumerate(doc)], least)
        assert not left


def test_contamination(spark, docs):
    rng = random.Random(4)
    passage = prose(rng, 40)
    w = passage.split()
    shuffled = " ".join(w[20:40] + w[0:20])
    rows = [
        (1, "start " + passage.upper() + ", end"),
        (2, prose(rng, 10) + " " + shuffled),
        (3, " ".join(w[:12])),
        (4, prose(rng, 50)),
        (5, None),
        (6, "so it goes"),
        (1, "start " + passage.upper() + ", end"),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(10, passage), (11, None), (12, "it goes"), (13, passage)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in tiling.contaminated_pairs(documents, benchmark).collect()}
    assert set(found) == {(1, 10), (2, 10), (1, 13), (2, 13), (6, 12)}
    assert found[6, 12].covered == 2 and found[6, 12].n_tiles == 1
    assert found[1, 10].covered == 40 and found[2, 10].n_tiles == 2 and found[2, 10].coverage == 1.0
    in_blocks = tiling.contaminated_pairs(documents, benchmark, block_seeds=10)
    assert {(r.doc_id, r.item_id) for r in in_blocks.collect()} == set(found)
    whole = tiling.contaminated_pairs(spark.createDataFrame([(1, "it goes"), (2, "goes it")], "doc_id long, text string"), benchmark)
    assert {(r.doc_id, r.item_id) for r in whole.collect()} == {(1, 12)}
    assert tiling.contaminated_pairs(documents.limit(0), benchmark).count() == 0
    assert tiling.contaminated_pairs(documents, benchmark.limit(0)).count() == 0
    assert tiling.contaminated_pairs(docs, benchmark).count() == 0


def test_short_items_inside_texts(spark):
    rng = random.Random(8)
    vocabulary = ["so", "it", "goes", "on", "and"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12))) for _ in range(60)]
    items = ["on", "it goes", "goes so on", "it on so and", "", "goes goes goes goes"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in tiling.contaminated_pairs(documents, benchmark, block_seeds=2).collect()}
    wanted = {
        (d, i) for d, text in enumerate(texts) for i, item in enumerate(items) if item and f" {item} " in f" {text} "
    }
    assert found == wanted and {i for _, i in wanted} >= {0, 1, 2}


# -- one-permutation fingerprints --


def test_edited_texts_and_neighbours(spark, docs, doc_rows):
    rows = sorted(((r[0], r[1] or "") for r in doc_rows), reverse=True)
    for partitions in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found = sorted(map(tuple, oneperm.with_next(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint").collect()))
        expected = []
        for i, (doc_id, text) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][1]
            half = len(text) // 2
            made = text[: len(text) - half] + following[:half]
            expected.append((doc_id, len(text), hashlib.sha256(made.encode()).hexdigest()))
        assert [f[:3] for f in found] == sorted(expected)
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    marks = collections.defaultdict(set)
    for doc_id, *_, mark in found:
        marks[doc_id].add(mark)
    assert marks[24] == marks[27] and len(marks[24]) == 1  # equal texts
    assert oneperm.with_next(docs.limit(0)).count() == 0
    one = oneperm.with_next(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_likeness_is_near_jaccard():
    import pyarrow as pa

    rng = random.Random(8)
    pairs = []
    for changes in (0, 1, 3, 8, 20):
        for _ in range(12):
            w = prose(rng, 300).split()
            v = list(w)
            for i in rng.sample(range(300), changes):
                v[i] = "new" + str(i)
            pairs.append((" ".join(w), " ".join(v)))
    a, b = (oneperm.fingerprints(pa.array([p[k] for p in pairs], pa.large_string())) for k in (0, 1))
    truth = np.array([jaccard(shingles(x), shingles(y)) for x, y in pairs])
    error = oneperm.likeness(a, b) - truth
    assert np.abs(error).max() < 0.16 and abs(error.mean()) < 0.02
    assert (oneperm.likeness(a, b)[:12] == 1).all()
    low = oneperm.fingerprints(pa.array(["", "a b", "?"], pa.large_string()))
    assert oneperm.likeness(low[[0, 0]], low[[2, 1]]).tolist() == [1.0, 0.0]


# -- near-duplicates --


def slow_classes(rows):
    texts = {d: t or "" for d, t in rows}
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            linked = prob_jaccard(sets[a], sets[b]) >= 0.8 if sets[a] and sets[b] else not sets[a] and texts[a] == texts[b] and not sets[b]
            if linked:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: root(d) for d in ids}


@pytest.mark.parametrize("small", [4, 1, 100])
def test_classes_match_brute_force(spark, docs, doc_rows, small):
    rng = random.Random(9)
    rows = [(r[0], r[1]) for r in doc_rows]
    base = prose(rng, 100).split()
    for i in range(40):  # a hub and its copies, most of them too far from each other
        copy = list(base)
        for k in rng.sample(range(100), 1 + i % 5):
            copy[k] = f"z{i}x{k}"
        rows.append((2000 + i, " ".join(copy)))
    rows.append((1999, " ".join(base)))
    rows.append((None, "no id"))
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.class_id for r in probminhash.near_duplicates(documents, small=small).collect()}
    assert found == slow_classes([r for r in rows if r[0] is not None])


@pytest.mark.parametrize("small", [4, 1])
def test_repeated_passages_are_linked_by_the_probability_index(spark, small):
    rng = random.Random(11)
    rows = []
    for i in range(6):
        passage = prose(rng, 100)
        w = passage.split()
        w[50] = f"other{i}"
        rows += [(10 * i, passage), (10 * i + 1, " ".join([passage] * 3)), (10 * i + 2, " ".join([" ".join(w)] * 2))]
        w[5:95:6] = [f"new{i}x{k}" for k in range(15)]
        rows += [(10 * i + 3, " ".join([" ".join(w)] * 4))]
    sets = {d: shingles(t) for d, t in rows}
    assert prob_jaccard(sets[0], sets[1]) > 0.9 and weighted_jaccard(sets[0], sets[1]) < 0.4
    expected = {d: d for d, _ in rows}
    links = [(a, b) for a in sets for b in sets if a // 10 == b // 10 and prob_jaccard(sets[a], sets[b]) >= 0.8]
    for _ in range(4):  # least ids along links
        for a, b in links:
            expected[a] = min(expected[a], expected[b])
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in probminhash.near_duplicates(documents, small=small).collect()}
    assert found == expected and len(set(found.values())) == 12


@pytest.mark.parametrize("small", [4, 1])
def test_one_group_of_repeating_texts_matches_brute_force(spark, small):
    rng = random.Random(21)
    base = [prose(rng, 30) for _ in range(3)]
    extra = [prose(rng, 12) for _ in range(3)]
    rows = []
    for i in range(90):  # lines repeated in various numbers, lines of their own and shared ones, changed words
        lines = [w for j, line in enumerate(base) for w in [line] * (3 + (rng.random() < 0.1) * (j + 1))]
        lines += [extra[rng.randrange(3)]] * rng.choice([0, 0, 0, 1, 2, 3])
        words = " ".join(lines).split()
        changed = {w: f"{w}x{i}" for w in rng.sample(sorted(set(words)), i % 4)}
        rows.append((i, " ".join(changed.get(w, w) for w in words)))
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in probminhash.near_duplicates(documents, small=small).collect()}
    expected = slow_classes(rows)
    assert found == expected and 5 < len(set(expected.values())) < 85


def test_bounds_beside_a_hub_lose_no_link(spark):
    rng = np.random.default_rng(31)
    near, rows = 0, []
    for group in range(150):
        pool = np.unique(rng.integers(1, 2**40, 50)).astype(np.uint64)
        hub = rng.integers(0, 4, len(pool))
        both = []
        for _ in range(2):
            counts = np.where(rng.random(len(pool)) < 0.12, rng.integers(0, 5, len(pool)), hub) * rng.choice([1, 1, 1, 3])
            counts[0] = max(counts[0], 1)
            both.append((pool[counts > 0], counts[counts > 0]))
        marks = []
        for elements, counts in both:
            center = (pool[hub > 0], hub[hub > 0])
            *_, (uneven, fresh, top), news = probminhash.differences(*center, elements, counts)
            occurring = np.repeat(elements, counts)
            nth = np.arange(len(occurring)) - np.repeat(np.cumsum(counts) - counts, counts)
            occurring = occurring + (nth.astype(np.uint64) << np.uint64(48))
            size = len(occurring)
            like = probminhash.prob_jaccard(*center, elements, counts)
            cuts = np.array([0, len(elements)])
            parity = probminhash.parity_bits(occurring, np.array([0, size]))[0].tolist()
            shares = [float(v) for v in probminhash.binned_shares(elements, counts, cuts)]
            marks.append((True, shares, size, *parity, like, uneven, fresh, top, *news.tolist()))
        linked = probminhash.prob_jaccard(*both[0], *both[1]) >= 0.8
        near += linked
        rows.append((bool(linked), *marks))
    names = [f"b{i} long" for i in range(probminhash.MARKS)], [f"f{i} long" for i in range(probminhash.MARKS)]
    mark = "struct<{}>".format(
        ",".join(
            c.replace(" ", ":", 1)
            for c in ["repeats boolean", "shares array<double>", "size int", *names[0], "likeness double", "uneven double",
                      "fresh double", "top double", *names[1]]
        )
    )
    pairs = spark.createDataFrame(rows, f"linked boolean, mx {mark}, mark {mark}")
    told = pairs.select("linked", probminhash.uneven_can_meet("mx", "mark", 0.8).alias("may")).collect()
    assert near > 15 and all(r.may for r in told if r.linked) and not all(r.may for r in told)


def test_bounds_of_shares_lose_no_link():
    rng = np.random.default_rng(5)
    for _ in range(200):
        e = np.unique(rng.integers(1, 2**40, 60)).astype(np.uint64)
        wa, wb = rng.integers(1, 30, (2, len(e)))
        wb = np.where(rng.random(len(e)) < 0.9, wa, wb)
        sums = [probminhash.binned_shares(e, w, np.array([0, len(e)])) for w in (wa, wb)]
        exact = prob_jaccard(collections.Counter(dict(zip(e, wa.tolist()))), collections.Counter(dict(zip(e, wb.tolist()))))
        assert probminhash.prob_jaccard(e, wa, e, wb) == pytest.approx(exact)
        assert np.abs(sums[0] - sums[1]).sum() <= 2 * (1 - exact) + 1e-4


def test_no_documents(docs):
    assert probminhash.near_duplicates(docs.limit(0)).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(1, 2**40, 200)).astype(np.uint64)
    wa, wb = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(a))
    keep_a, keep_b = np.arange(len(a)) % 10 != 0, np.arange(len(a)) % 10 != 5
    x, y = (a[keep_a], wa[keep_a]), (a[keep_b], wb[keep_b])
    bounds = np.array([0, len(x[0]), len(x[0]) + len(y[0])])
    sig = probminhash.prob_minhash(np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]), bounds, 4096)
    exact = prob_jaccard(collections.Counter(dict(zip(*x))), collections.Counter(dict(zip(*y))))
    assert exact >= weighted_jaccard(collections.Counter(dict(zip(*x))), collections.Counter(dict(zip(*y))))
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03
