"""Plain restatements of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
from math import log2


def secret_spans(text, scan):
    kinds = (
        ("assign", re.compile(scan.ASSIGN)),
        ("access", re.compile(r"AKIA[A-Z0-9]+")),
        ("hex", re.compile(r"[0-9a-f]+")),
    )
    base = []
    for rank, (kind, pattern) in enumerate(kinds):
        for m in pattern.finditer(text):
            fits = {
                "assign": lambda m: len(m[2]) >= 12,
                "access": lambda m: len(m[0]) >= 18,
                "hex": lambda m: len(m[0]) >= 16,
            }[kind](m)
            if fits:
                base.append((m.start(), m.end(), rank, kind))
    base.sort()
    more = []
    covered = {i for start, end, _, _ in base for i in range(start, end)}
    free = "".join(" " if i in covered else c for i, c in enumerate(text))

    def entropy(w):
        return -sum(w.count(c) / len(w) * log2(w.count(c) / len(w)) for c in set(w))

    for m in re.finditer(r"[A-Za-z0-9+/_=-]{12,}", free):
        run = m[0]
        short = len(run) < scan.WINDOW
        allowed = scan.ALLOWED + (scan.ALLOWED_SHORT if short else ())
        if not re.search("[0-9]", run) or not re.search("[A-Za-z]", run) or any(re.search(p, run) for p in allowed):
            continue
        kind = "entropy_hex" if re.fullmatch("[0-9a-fA-F]+", run) else "entropy_key"
        window, bits = (scan.SHORT_WINDOW, scan.SHORT_BITS) if short else (scan.WINDOW, scan.BITS)
        best = max(entropy(run[i : i + window]) for i in range(len(run) - window + 1))
        if best >= bits[kind] - 1e-6:
            more.append((m.start(), m.end(), scan.KINDS.index(kind), kind))
    return base, sorted(base + more)


def shown(spans):
    return ",".join(f"{k}:{s}:{e}" for s, e, _, k in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
