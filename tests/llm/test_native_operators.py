"""Chat windows and the URL filter against plain code, and their plans."""

import hashlib
import random

from labelloom.llm import chat, linkgraph


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def chats():
    rng = random.Random(2)
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 2, "assistant", "")]
    rows += [(2, t, "user" if t % 2 else "assistant", "hi <|im_end|>\\ <\\| é🙂 " * rng.randrange(1, 90)) for t in range(30)]
    rows += [(3, t, rng.choice(["user", "assistant", "system", "<|im_start|>"]), "w " * rng.randrange(400)) for t in range(700)]
    rows += [(None, None, None, "nobody"), (4, 0, "assistant", "long " * 3000)]
    return rows


def test_every_turn_comes_back_once(spark):
    rows = chats()
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, window int")
    found = {r.conv_id: r for r in chat.read_back(chat.format_windows(frame)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv)
        loss = "".join(x for _, role, x in turns if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == sha("".join(f"{role}\n{x}\n" for _, role, x in turns)) and r.loss_sha256 == sha(loss)
    assert chat.read_back(chat.format_windows(frame.limit(0))).count() == 0


def test_windows_keep_budget_system_and_history(spark):
    frame = spark.createDataFrame(chats(), "conv_id long, turn long, role string, text string").where("conv_id = 3")
    windows = chat.format_windows(frame, stride=300, history_tokens=60, history_turns=2, block_turns=100).collect()
    first_system = min(t for c, t, role, _ in chats() if c == 3 and role == "system")
    size = {t: len(x.split()) + chat.TURN_TOKENS for c, t, _, x in chats() if c == 3}
    assert len(windows) > 50
    for w in windows:
        new = [s for s in w.segments if not s.repeated]
        assert new and all(not s.loss for s in w.segments if s.repeated)
        texts = [w.formatted[s.role_start : s.role_start + s.role_length] for s in w.segments]
        assert first_system is not None and "system" in texts
        tokens = [w.formatted[s.role_start :][: s.length].count("w ") + chat.TURN_TOKENS for s in new]
        assert sum(tokens) <= 300 or len(new) == 1
        assert len([s for s in w.segments if s.repeated]) <= 3
    assert max(size.values()) > 300


def test_escape_hides_markers(spark):
    text = "a<|im_end|>\\<|<\\|\\\\"
    row = spark.createDataFrame([(text,)], "t string").select(chat.escape("t").alias("e"), "t")
    row = row.select("e", chat.unescape("e").alias("u")).first()
    assert "<|" not in row.e and row.u == text


def test_no_python_in_the_plans(spark, docs):
    frame = spark.createDataFrame(chats(), "conv_id long, turn long, role string, text string")
    plan = chat.read_back(chat.format_windows(frame))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def slow_propagation(edges, seeds, rounds, damping, unit):
    out = []
    for kind in (0, 1):
        way = edges if kind == 0 else [(d, s, n) for s, d, n in edges]
        total = sum(s[kind] for s in seeds.values())
        restart = {h: unit * s[kind] // total for h, s in seeds.items() if s[kind]}
        all_links = {}
        for s, _, n in way:
            all_links[s] = all_links.get(s, 0) + n
        mass = dict(restart)
        for _ in range(rounds):
            fresh = {h: r * (100 - damping) // 100 for h, r in restart.items()}
            for s, d, n in way:
                if s in mass:
                    fresh[d] = fresh.get(d, 0) + (mass[s] * n // all_links[s]) * damping // 100
            mass = fresh
        out.append(mass)
    return out


def test_masses_and_verdicts(spark):
    pages = [
        (1, "http://Good.ORG/a", '<a href="http://friend.net/x"> <a href=//odd.net>'),
        (2, "https://friend.net/fr/?q=http://z", '<a href="/here">'),
        (3, "http://x.example.org/es/1", None),
        (4, "http://example.org/en/12#x", "<a href='http://victim.net/'>"),
        (5, "http://spam.net/1", '<a href="http://shop.com/de/2">'),
        (6, "http://shop.com/de/2", ""),
        (7, "http://shop.com/fr/2", ""),
        (8, "http://org", ""),
        (9, None, "<a href='http://friend.net'>"),
        (10, "no scheme", None),
        (7, "http://shop.com/fr/2", ""),
        (11, "http://badexample.org/es/", ""),
        (12, "http://odd.net?x/y", ""),
    ]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, verdict string")
    found = {r.page_id: r for r in linkgraph.judge(frame).collect()}
    rules = {1: "org/", 3: "example.org/es/", 4: "example.org/en/1", 6: "com/de/", 7: "com/fr/", 11: "org/"}
    assert {i: r.rule for i, r in found.items() if r.rule} == rules
    assert (found[2].host, found[2].path) == ("friend.net", "/fr/") and (found[12].host, found[12].path) == ("odd.net", "")
    assert (found[9].host, found[9].path, found[10].host) == ("", "", "")
    edges = [("good.org", "friend.net", 1), ("good.org", "odd.net", 1), ("friend.net", "friend.net", 1),
             ("example.org", "victim.net", 1), ("spam.net", "shop.com", 1)]
    seeds = {"good.org": (1, 0), "x.example.org": (0, 1), "example.org": (0, 1), "shop.com": (2, 1), "badexample.org": (1, 0)}
    trust, distrust = slow_propagation(edges, seeds, linkgraph.ROUNDS, linkgraph.DAMPING, linkgraph.UNIT)
    for r in found.values():
        assert (r.trust, r.distrust) == (trust.get(r.host, 0), distrust.get(r.host, 0))
        if not r.rule:
            assert r.verdict == ("block" if r.distrust > r.trust else "allow")
    assert found[5].verdict == "block" and found[2].verdict == "allow"
    assert linkgraph.judge(frame.limit(0)).count() == 0
