"""Language-model scoring with a gated recurrent network.

Tokens are words between ASCII white space with A-Z in lower case, and one end per document. Word counts, over all
training documents, are a Spark aggregation; they give the unigram base. The ``HEAD`` most frequent words and the end
are entries of a GRU; all other words are one further class of its output, inside which a word has the probability of
its count (add-one, with room for one unknown word), so every text has a probability under the model.

The output is factored: classes of about equal summed square-root frequency, then a softmax over the class's words.
Training is truncated backpropagation in numpy: windows of ``WINDOW`` steps over lanes that run through whole
documents, state carried from window to window and cleared at document starts. The rounds part the training documents
by hash, so together they read every one of them once; in a round every task trains on those of its input split, and
the parameters are averaged in a tree. Scoring runs the same way over all documents and all their tokens.

Words outside the ``LOOKUP`` most frequent ones, which tasks hold in memory, get their counts from a join on the word;
such words are rare by definition, so the join has no hot keys.

Defined cases: a null or empty text is a single end; a null document id counts as the empty text in the split of held
out documents; repeated rows are scored, and learned from, one by one; an empty table gives no rows, and with no
training documents all counts are zero; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import shingles
from labelloom.session import ship_package, stage

END = "\n"  # no word holds white space
FOLDS, HELD_OUT = 7, 2
HEAD, LOOKUP = 2047, 200_000
UNITS, CLASSES, WINDOW, LANES = 24, 64, 32, 64
ROUNDS, RATE = 3, 0.008
SCORE_LANES, SLICE_BYTES, FANOUT = 256, 8_000_000, 32


def split_tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, all words as places in that list, and every text's bounds (without ends)."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    distinct, places = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    if "" in distinct:
        kept = places != distinct.index("")
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        places = places[kept]
    return distinct, places, bounds


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def held_out_column():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over the training documents; the end is a word."""
    ship_package(docs.sparkSession)

    def run(batches):
        from labelloom.llm import gru as g
        from labelloom.llm import shingles as s

        for batch in batches:
            for _, texts in s.slices(batch.column("text"), 2 * g.SLICE_BYTES):
                distinct, places, _ = g.split_tokens(texts)
                counts = np.bincount(places, minlength=len(distinct))
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array([*map(distinct.__getitem__, used.tolist()), g.END], pa.string()),
                        "c": pa.array(np.append(counts[used], len(texts)), pa.int64()),
                    }
                )

    training = docs.where(~held_out_column()).select("text")
    return training.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What tasks need of the counts: bounded by ``LOOKUP``."""

    counts: dict[str, int]  # of the most frequent words
    entry: dict[str, int]  # of the network's words, by class; the end among them
    class_of: np.ndarray  # per entry; the last, one beyond the words, is the class of all other words
    class_start: np.ndarray
    frequency: np.ndarray  # per entry, the other words last
    total: int
    distinct: int
    rest_total: int
    rest_distinct: int


def vocabulary(counts: DataFrame, head: int = HEAD, lookup: int = LOOKUP, classes: int = CLASSES) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = [(r["word"], r["c"]) for r in counts.orderBy(F.desc("c"), "word").limit(lookup).toPandas().to_dict("records")]
    chosen = [(w, c) for w, c in top if w != END][:head] + [(END, dict(top).get(END, 0))]
    chosen.sort(key=lambda x: (-x[1], x[0]))
    weight = np.sqrt(np.array([c for _, c in chosen], dtype=np.float64) + 1e-9)
    share = np.cumsum(weight) / weight.sum()
    group = np.minimum((share - share[0]) * classes, classes - 1).astype(np.int64)
    group = np.unique(group, return_inverse=True)[1]
    rest = total - sum(c for _, c in chosen)
    return Vocabulary(
        dict(top),
        {w: i for i, (w, _) in enumerate(chosen)},
        np.append(group, group[-1] + 1),
        np.searchsorted(group, np.arange(group[-1] + 2)),
        np.array([c for _, c in chosen] + [rest], dtype=np.float64),
        int(total),
        int(distinct),
        int(rest),
        int(distinct - sum(c > 0 for _, c in chosen)),
    )


# -- the network --------------------------------------------------------------------------------------------------


def new_parameters(v: Vocabulary, units: int = UNITS) -> dict[str, np.ndarray]:
    """Small random weights; output biases are log frequencies, so training starts at the unigram model."""
    rng = np.random.default_rng(7)
    words, classes = len(v.entry), int(v.class_of[-1]) + 1
    smooth = v.frequency + 1
    by_class = np.bincount(v.class_of, smooth)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(units)).astype(np.float32)
    return {
        "wx": 0.3 * draw(words + 1, 3 * units),
        "bx": np.zeros(3 * units, np.float32),
        "u": draw(units, 2 * units),
        "un": draw(units, units),
        "wc": 0.1 * draw(units, classes),
        "bc": np.log(by_class / by_class.sum()).astype(np.float32),
        "wo": 0.1 * draw(words, units),
        "bo": np.log(smooth[:-1] / by_class[v.class_of[:-1]]).astype(np.float32),
    }


def pack(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[k].reshape(-1) for k in sorted(parameters)])


def unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def run_window(p: dict, h: np.ndarray, x: np.ndarray, fresh: np.ndarray, active: np.ndarray, trace: list | None = None):
    """States after every step of a window, ``(steps, lanes, units)``, and the last one.

    ``x`` and ``fresh`` (the step opens a document) are ``(steps, lanes)``; step t has its ``active[t]`` first lanes.
    """
    units = h.shape[1]
    out = np.zeros((*x.shape, units), np.float32)
    gates = p["wx"][x] + p["bx"]
    for t in range(len(x)):
        n = active[t]
        before = h[:n] * (~fresh[t, :n])[:, None]
        rz = _sigmoid(gates[t, :n, : 2 * units] + before @ p["u"])
        r, z = rz[:, :units], rz[:, units:]
        new = np.tanh(gates[t, :n, 2 * units :] + (r * before) @ p["un"])
        h[:n] = new + z * (before - new)
        out[t, :n] = h[:n]
        if trace is not None:
            trace.append((before, r, z, new))
    return out, h


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def word_log_probabilities(p: dict, v: Vocabulary, states: np.ndarray, target: np.ndarray, grads: dict | None = None):
    """Natural log probability of every target after its state: its class, then itself inside the class.

    With ``grads`` the gradients of the summed negative log probability are added there, and the one of the states is
    returned as well.
    """
    kind = v.class_of[target]
    by_class = log_softmax(states @ p["wc"] + p["bc"])
    rows = np.arange(len(target))
    out = by_class[rows, kind]
    slope = None
    if grads is not None:
        d = np.exp(by_class)
        d[rows, kind] -= 1
        grads["wc"] += states.T @ d
        grads["bc"] += d.sum(axis=0)
        slope = d @ p["wc"].T
    order = np.argsort(kind, kind="stable")
    ends = np.searchsorted(kind[order], np.arange(int(v.class_of[-1]) + 1))
    for k in range(int(v.class_of[-1])):
        some = order[ends[k] : ends[k + 1]]
        lo, hi = v.class_start[k], v.class_start[k + 1]
        if not len(some) or hi - lo == 1:
            continue
        inside = log_softmax(states[some] @ p["wo"][lo:hi].T + p["bo"][lo:hi])
        at = target[some] - lo
        out[some] += inside[np.arange(len(some)), at]
        if grads is not None:
            d = np.exp(inside)
            d[np.arange(len(some)), at] -= 1
            grads["wo"][lo:hi] += d.T @ states[some]
            grads["bo"][lo:hi] += d.sum(axis=0)
            slope[some] += d @ p["wo"][lo:hi]
    return out, slope


def window_gradients(p: dict, v: Vocabulary, h: np.ndarray, x, y, fresh, active) -> tuple[dict, np.ndarray, float, int]:
    """Gradients of the mean loss of one window by truncated backpropagation, the state after it, loss and tokens."""
    trace: list = []
    states, h = run_window(p, h, x, fresh, active, trace)
    used = np.arange(x.shape[1]) < active[:, None]
    grads = {k: np.zeros_like(w) for k, w in p.items()}
    logs, slope = word_log_probabilities(p, v, states[used], y[used], grads)
    into = np.zeros_like(states)
    into[used] = slope
    units = h.shape[1]
    gate_slopes = np.zeros((*x.shape, 3 * units), np.float32)
    carried = np.zeros_like(h)
    for t in range(len(x) - 1, -1, -1):
        n = active[t]
        before, r, z, new = trace[t]
        dh = into[t, :n] + carried[:n]
        dnew = dh * (1 - z) * (1 - new * new)
        dz = dh * (before - new) * z * (1 - z)
        reset = dnew @ p["un"].T
        dr = reset * before * r * (1 - r)
        drz = np.hstack([dr, dz])
        grads["un"] += (r * before).T @ dnew
        grads["u"] += before.T @ drz
        gate_slopes[t, :n] = np.hstack([drz, dnew])
        carried[:n] = (dh * z + reset * r + drz @ p["u"].T) * (~fresh[t, :n])[:, None]
    flat, tokens = gate_slopes[used], x[used]
    grads["bx"] += flat.sum(axis=0)
    order = np.argsort(tokens, kind="stable")
    first = np.flatnonzero(np.diff(tokens[order], prepend=-1))
    grads["wx"][tokens[order][first]] = np.add.reduceat(flat[order], first, axis=0)
    count = int(used.sum())
    for g in grads.values():
        g /= count
    return grads, h, float(-logs.sum()), count


# -- lanes --------------------------------------------------------------------------------------------------------


def lanes(entries: np.ndarray, bounds: np.ndarray, end: int, count: int):
    """Documents dealt to lanes of about equal length, longest first, as ``(x, y, fresh, place, active)``.

    ``y`` is a document's words and its end, ``x`` the token before (an end at first), ``place`` the position of every
    target in the flat order of all targets, document after document. Lanes are sorted by length, so the ones still
    running at a step are the first ``active`` ones.
    """
    sizes = np.diff(bounds) + 1
    heap = [(0, i) for i in range(min(count, max(len(sizes), 1)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for doc in np.argsort(-sizes, kind="stable").tolist():
        size, lane = heapq.heappop(heap)
        dealt[lane].append(doc)
        heapq.heappush(heap, (size + int(sizes[doc]), lane))
    length = {lane: size for size, lane in heap}
    order = sorted(length, key=lambda i: -length[i])
    steps = length[order[0]] if order else 0
    closed = np.insert(entries, bounds[1:], end)
    begins = np.cumsum(sizes) - sizes
    place = np.full((steps, len(order)), -1, dtype=np.int64)
    fresh = np.zeros((steps, len(order)), dtype=bool)
    for column, lane in enumerate(order):
        at = 0
        for doc in dealt[lane]:
            place[at : at + sizes[doc], column] = np.arange(begins[doc], begins[doc] + sizes[doc])
            fresh[at, column] = True
            at += int(sizes[doc])
    y = np.where(place >= 0, closed[place], end)
    x = np.vstack([np.full((1, len(order)), end, dtype=y.dtype), y[:-1]]) if steps else y
    x = np.where(fresh, end, x)
    active = np.array([(place[t] >= 0).sum() for t in range(steps)], dtype=np.int64)
    return x, y, fresh, place, active


def entries_of(v: Vocabulary, distinct: list[str]) -> np.ndarray:
    other = len(v.entry)
    return np.array([v.entry.get(w, other) for w in distinct], dtype=np.int64) if distinct else np.empty(0, np.int64)


def train_on(p: dict, v: Vocabulary, pieces, rate: float = RATE) -> tuple[dict, int, float]:
    """Adam over all windows of all pieces ``(entries, bounds)``; parameters, tokens seen and their summed loss."""
    p = {k: w.copy() for k, w in p.items()}
    first, second = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    step, seen, lost = 0, 0, 0.0
    for entries, bounds in pieces:
        count = int(np.clip((len(entries) + len(bounds)) // (40 * WINDOW), 2, LANES))
        x, y, fresh, _, active = lanes(entries, bounds, v.entry[END], count)
        h = np.zeros((x.shape[1], p["u"].shape[0]), np.float32)
        for t in range(0, len(x), WINDOW):
            cut = slice(t, t + WINDOW)
            grads, h, loss, n = window_gradients(p, v, h, x[cut], y[cut], fresh[cut], active[cut])
            step, seen, lost = step + 1, seen + n, lost + loss
            for k, g in grads.items():
                np.clip(g, -1, 1, out=g)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.005 * (g * g - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.995**step)) + 1e-6)
    return p, seen, lost


def document_scores(p: dict, v: Vocabulary, entries: np.ndarray, bounds: np.ndarray, count: int = SCORE_LANES) -> np.ndarray:
    """Natural log probability of every whole document, other words as their class."""
    x, y, fresh, place, active = lanes(entries, bounds, v.entry[END], count)
    logs = np.zeros(len(entries) + len(bounds) - 1)
    h = np.zeros((x.shape[1], p["u"].shape[0]), np.float32)
    for t in range(0, len(x), WINDOW):
        cut = slice(t, t + WINDOW)
        width = int(active[t])
        states, h[:width] = run_window(p, h[:width], x[cut, :width], fresh[cut, :width], active[cut])
        used = place[cut, :width] >= 0
        logs[place[cut, :width][used]] = word_log_probabilities(p, v, states[used], y[cut, :width][used])[0]
    ends = np.cumsum(np.diff(bounds) + 1)
    total = np.concatenate([[0.0], np.cumsum(logs)])
    return total[ends] - total[ends - np.diff(bounds) - 1]


# -- Spark --------------------------------------------------------------------------------------------------------


def round_of(rounds: int = ROUNDS):
    """The round that a document is learned in; rows without an id are dealt by their text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text"))), F.lit(rounds))


def train(docs: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameters after ``rounds`` of training, each on its part of the training documents, and averaging."""
    spark = docs.sparkSession
    ship_package(spark)
    p = new_parameters(v)
    like = {k: np.empty(w.shape, np.float32) for k, w in p.items()}
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((pack(p), v))  # about 1 MB and LOOKUP words, whatever the input

        def run(batches, sent=sent):
            from labelloom.llm import gru as g
            from labelloom.llm import shingles as s

            flat, v = sent.value

            def pieces():
                for batch in batches:
                    for _, texts in s.slices(batch.column("text"), g.SLICE_BYTES):
                        distinct, places, bounds = g.split_tokens(texts)
                        yield g.entries_of(v, distinct)[places], bounds

            p, seen, _ = g.train_on(g.unpack(flat, like), v, pieces())
            if seen:
                yield pa.RecordBatch.from_pydict(
                    {"slot": [zlib.crc32(g.pack(p).tobytes())], "seen": [seen], "flat": [g.pack(p).astype("<f4").tobytes()]}
                )

        def mean(table):
            from labelloom.llm.gru import averaged

            return averaged(table)

        part = docs.where(~held_out_column() & (round_of(rounds) == turn)).select("text")
        schema = "slot long, seen long, flat binary"
        trained = stage(part.mapInArrow(run, schema), "trained")
        n = trained.count()
        while n > 1:
            n = -(-n // FANOUT)
            trained = trained.groupBy(F.pmod(F.xxhash64("slot"), F.lit(n)).alias("met")).applyInArrow(mean, schema)
        row = trained.first()
        if row is not None:
            p = unpack(np.frombuffer(row["flat"], "<f4"), like)
        sent.unpersist()
    return p


def averaged(table: pa.Table) -> pa.Table:
    """One row: parameters averaged by the tokens they were trained on."""
    seen = np.array(table.column("seen").to_pylist(), dtype=np.float64)
    total = None
    for weight, flat in zip(seen / seen.sum(), table.column("flat").to_pylist()):
        part = weight * np.frombuffer(flat, "<f4").astype(np.float64)
        total = part if total is None else total + part
    return pa.table(
        {
            "slot": pa.array([table.column("slot")[0].as_py()], pa.int64()),
            "seen": pa.array([int(seen.sum())], pa.int64()),
            "flat": pa.array([total.astype("<f4").tobytes()], pa.binary()),
        }
    )


def score(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of all whole documents."""
    spark = docs.sparkSession
    ship_package(spark)
    counts = stage(word_counts(docs), "word-counts")
    v = vocabulary(counts)
    p = train(docs, v)
    sent = spark.sparkContext.broadcast((p, v))  # bounded by HEAD and LOOKUP

    def run(batches):
        from pyspark import TaskContext

        from labelloom.llm import gru as g
        from labelloom.llm import shingles as s

        p, v = sent.value
        row = TaskContext.get().partitionId() << 40
        end_gain = np.log10(v.counts.get(g.END, 0) + 1)
        for batch in batches:
            for at, texts in s.slices(batch.column("text"), g.SLICE_BYTES):
                distinct, places, bounds = g.split_tokens(texts)
                entries = g.entries_of(v, distinct)
                found = np.array([v.counts.get(w, -1) for w in distinct], dtype=np.int64)
                gain = np.log10(np.maximum(found, 0) + 1.0)
                n, owner = len(texts), np.repeat(np.arange(len(texts)), np.diff(bounds))
                per_doc = lambda x: np.bincount(owner, x, minlength=n).astype(np.float64)
                looked_up, other = found[places] < 0, entries[places] == len(v.entry)
                rare = np.flatnonzero(looked_up)
                cuts = np.searchsorted(owner[rare], np.arange(n + 1))
                words = pa.array(distinct, pa.string()).take(pa.array(places[rare]))
                ids = batch.column("doc_id").slice(at, n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(np.arange(row, row + n)),
                        "doc_id": ids,
                        "held_out": pa.array([g.is_held_out(i) for i in ids.to_pylist()], pa.bool_()),
                        "n_tokens": pa.array(np.diff(bounds) + 1, pa.int64()),
                        "known": pa.array(per_doc(found[places] > 0).astype(np.int64) + int(v.counts.get(g.END, 0) > 0)),
                        "gain": pa.array(per_doc(gain[places]) + end_gain),
                        "other": pa.array(per_doc(other).astype(np.int64)),
                        "other_gain": pa.array(per_doc(gain[places] * other)),
                        "neural": pa.array(g.document_scores(p, v, entries[places], bounds) / np.log(10)),
                        "rare": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words),
                    }
                )
                row += n

    made = stage(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            run,
            "row long, doc_id long, held_out boolean, n_tokens long, known long, gain double, other long,"
            " other_gain double, neural double, rare array<string>",
        ),
        "scored-documents",
    )
    # Rare words: none of them is an entry of the network, so their gain counts on both sides.
    rare = made.select("row", F.explode("rare").alias("word")).join(counts, "word")
    sums = rare.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("more_gain"))
    more, more_gain = F.coalesce("more", F.lit(0)), F.coalesce("more_gain", F.lit(0.0))
    base_room = float(np.log10(v.total + v.distinct + 1))
    rest_room = float(np.log10(v.rest_total + v.rest_distinct + 1))
    return (
        made.drop("rare")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + more).alias("n_known"),
            F.lit(v.total).cast("long").alias("train_tokens"),
            (F.col("gain") + more_gain - F.col("n_tokens") * base_room).alias("base_score"),
            (F.col("neural") + F.col("other_gain") + more_gain - F.col("other") * rest_room).alias("score"),
        )
    )
