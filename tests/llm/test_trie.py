"""The prefix trie against a plain one built turn by turn."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from labelloom.llm import trie as t

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a int"


def plain(rows, group=20):
    by_conv = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by_conv.setdefault(conv, []).append(((turn is not None, turn or 0), key, role, text))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by_conv.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - int(c % group if c >= 0 else -(-c % group)), [])[:h] + own[c][h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:-1] == x for y in below if y)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].split()) for x in below if x)
        ends = sorted(c for c in convs if len(made[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(kids), len(leaves), saved, digest))
    return sorted(out)


def conversations(rng, n, most):
    """Conversations over few texts, so that many prefixes are shared, in any order of rows."""
    rows = []
    for c in range(n):
        kept = rng.randrange(most + 1)
        rows += [(c, k, rng.choice(("user", "assistant")), rng.choice(("a b", "c", "", " d  e\tf")), "x", 1) for k in range(kept)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,most,parts", [(1, 60, 4, 3), (2, 25, 9, 8)])
def test_equals_a_plain_trie(spark, seed, n, most, parts):
    rng = random.Random(seed)
    rows = conversations(rng, n, most)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = t.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert sorted(map(tuple, found)) == plain(rows)


def test_awkward_rows(spark):
    rng = random.Random(7)
    rows = conversations(rng, 30, 5)
    rows += rows[:5]  # repeated rows are turns of their own
    rows += [(None, 0, "user", "lost", "x", 1), (40, None, None, None, None, None), (40, None, "user", None, None, 1)]
    rows += [(41, 0, "user", "same turn", "x", 1), (41, 0, "user", "other text", "x", 1), (-7, 3, "user", "c", "x", 1), (-20, 3, "user", "c", "x", 1)]
    rows += [(60, i, "user", f"long {i % 3}", "x", 1) for i in range(150)] + [(61, i, "user", f"long {i % 3}", "x", 1) for i in range(130)]
    rows += [(c, 0, "user", "c", "x", 1) for c in range(100, 140)]
    found = t.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, found)) == plain(rows)


def test_empty_table(spark):
    found = t.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert found.columns[:3] == ["conv_id", "depth", "parent_conv_id"] and found.count() == 0


def test_any_cut_into_runs_gives_one_forest():
    """Contracting runs of any size and merging them equals one run over everything."""
    rng = random.Random(9)
    for _ in range(60):
        words = sorted("".join(rng.choices("ab", k=rng.randrange(6))) for _ in range(rng.randrange(1, 30)))
        name = lambda x: zlib.crc32(x.encode())
        rows = []
        for i, w in enumerate(words):
            path = [
                {"depth": d + 1, "a": name(w[: d + 1]) if d < len(w) else 0, "b": 0, "pa": name(w[:d]) if d else 0, "pb": 0, "before": d, "last": min(d, 1)}
                for d in range(len(w) + 1)
            ]
            rows.append({"conv_id": i, "depth": len(w), "a": name(w) if w else 0, "b": 0, "words": len(w), "last": min(len(w), 1), "path": path})

        def forest(part, nodes):
            edges = [t.shared(x, y) for x, y in zip(part, part[1:])]
            return (*t.contract([t.component(r) for r in part], edges, True, True, nodes), part[0], part[-1])

        results = []
        for most in (1, 2, 3, 7, len(rows)):
            nodes = []
            runs = [forest(rows[i : i + most], nodes) for i in range(0, len(rows), most)]
            while len(runs) > 1:
                runs = [t._merge(runs[i : i + 2], nodes) for i in range(0, len(runs), 2)]
            t.whole_forest(runs[0][0], runs[0][1], nodes)
            results.append(sorted(nodes))
        assert all(r == results[0] for r in results)
        spines = forest(rows, [])[0]
        assert len(spines) <= 2 * 6 + 1


def test_running_sums_join_over_partitions():
    left, right = (5, 3, 10, -20, 7, 2), (5, 2, 4, 9, 5, 1)
    whole = t.joined(left, right)
    assert whole[:2] == (5, 5) and whole[4:] == (12, 1)
    assert t.joined(t.joined(left, right), (5, 1, 8, 8, 1, 1)) == t.joined(left, t.joined(right, (5, 1, 8, 8, 1, 1)))
    assert isinstance(pa.array([whole[2]]), pa.Int64Array)
