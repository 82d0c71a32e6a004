"""Quality classifier by co-training.

Two views of a document are learned apart: its text (words, and shape: letters, capitals, marks, repetition) and its
metadata (language, source, length). Both start from the labelled documents. In every round each view labels the
unlabelled pool; documents it is sure about (calibrated probability beyond ``SURE``) become training rows of the other
view, at most ``PER_ROUND`` of a kind. In the end a logistic combination of both views, fitted on labelled rows that
neither has trained on, gives the probability that a document is good: of quality and not toxic.

Fitting is on bounded samples in hash order, at most ``LABELLED`` labelled and ``POOL`` unlabelled documents, on the
driver; features of the samples and the scores of all documents, whole texts, are computed in tasks.

Defined cases: null texts are empty and are scored by their lack of words; null metadata is a value of its own; null
labels are no labels; documents with several label rows are judged by the worst; without two labelled documents of
each kind every document is kept with probability one half; repeated rows are scored alike; an empty table gives no rows;
other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm import shingles
from labelloom.session import ship_package

LABELLED, POOL = 12_000, 4_000
ROUNDS, SURE, PER_ROUND = 3, 0.97, 500
BUCKETS, CHOSEN, LEAST_USE, LEAST_Z = 1 << 18, 2048, 5, 4.0
CUTS = 10
# Bytes of text whose characters and words a task measures at once.
SLICE_BYTES = 2_000_000
SHAPES = ("letters", "capitals", "digits", "marks", "bars", "line_words", "word_size", "repeats", "distinct")


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def _classes() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)  # 0: marks
    kinds[[*range(97, 123), *range(128, 256)]] = 1
    kinds[65:91], kinds[48:58], kinds[[9, 10, 11, 12, 13, 32]], kinds[ord("|")] = 2, 3, 4, 5
    return kinds


CLASSES = _classes()


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, every text's bounds, and a row of shape measures per text."""
    words, bounds = shingles.word_hashes(texts)
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    kinds = CLASSES[data[offsets[0] : offsets[-1]]]
    at = offsets - offsets[0]

    def per_text(flags: np.ndarray, cut: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[cut]).astype(np.float64)

    letters, capitals, digits = (per_text(kinds == k, at) for k in (1, 2, 3))
    marks, bars = per_text(kinds == 0, at), per_text(kinds == 5, at)
    lines = per_text(data[offsets[0] : offsets[-1]] == 10, at) + 1
    count = np.diff(bounds).astype(np.float64)
    size, some = np.maximum(np.diff(at), 1), np.maximum(count, 1)
    same = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.empty(0, dtype=bool)
    same[bounds[:-1][count > 0]] = False
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(bounds))
    pairs = np.unique((owner << np.uint64(40)) | (words >> np.uint64(24)))
    distinct = np.bincount((pairs >> np.uint64(40)).astype(np.int64), minlength=n)
    shape = np.stack(
        [
            letters / size,
            capitals / size,
            digits / size,
            marks / size,
            bars / size,
            count / lines,
            (letters + capitals) / some,
            per_text(same, bounds) / some,
            distinct / np.sqrt(some),
        ],
        axis=1,
    )
    return bucket_of(words), bounds, shape


def sampled_features(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, source, n_chars, good, buckets, shape)`` of a bounded sample of documents."""

    def run(batches):
        from labelloom.llm import cotrain as c
        from labelloom.llm import shingles as s

        for batch in batches:
            for at, texts in s.slices(batch.column("text"), c.SLICE_BYTES):
                buckets, bounds, shape = c.text_features(texts)
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_pydict(
                    {n: part.column(n) for n in ("doc_id", "lang", "source", "n_chars", "good")}
                    | {
                        "buckets": pa.array(
                            [np.unique(buckets[a:b]).astype(np.int32) for a, b in zip(bounds, bounds[1:])], pa.list_(pa.int32())
                        ),
                        "shape": pa.array(list(shape), pa.list_(pa.float64())),
                    }
                )

    return docs.select("doc_id", "lang", "source", "n_chars", "good", "text").mapInArrow(
        run, "doc_id long, lang string, source string, n_chars long, good boolean, buckets array<int>, shape array<double>"
    )


def cells(shape: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One column per measure and interval between cuts: the interval a measure lies in."""
    width = cuts.shape[1] + 1
    return np.stack([np.searchsorted(cuts[j], shape[:, j]) + j * width for j in range(shape.shape[1])], axis=1)


def metadata_columns(lang, source, n_chars, cuts: np.ndarray) -> np.ndarray:
    """Columns of language, source and length, three per document, below ``META``."""
    digest = shingles.xxhash.xxh3_64_intdigest
    langs = [digest(f"lang {x}") % 64 for x in lang]
    sources = [64 + digest(f"source {x}") % 1024 for x in source]
    sizes = 64 + 1024 + np.searchsorted(cuts, np.array([-1 if x is None else x for x in n_chars], dtype=np.float64))
    return np.stack([np.array(langs, dtype=np.int64), np.array(sources, dtype=np.int64), sizes.astype(np.int64)], axis=1)


META = 64 + 1024 + CUTS + 1


@dataclass
class Rows:
    """Sparse 0/1 rows."""

    columns: list[np.ndarray]

    def flat(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        picked = [self.columns[i] for i in rows]
        return np.repeat(np.arange(len(rows)), [len(p) for p in picked]), np.concatenate(picked) if picked else np.empty(0, int)


def fit_logistic(x: Rows, rows: np.ndarray, y: np.ndarray, width: int, steps: int = 300, penalty: float = 0.03) -> np.ndarray:
    """Weights and, last, the bias; full-batch Adam on the log loss with a squared penalty."""
    owner, column = x.flat(rows)
    weights, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(owner, weights[column], minlength=len(rows)) + weights[-1]
        slack = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / max(len(rows), 1)
        slope = np.append(np.bincount(column, slack[owner], minlength=width), slack.sum())
        slope[:-1] += penalty / max(len(rows), 1) * weights[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= 0.3 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return weights


def margins(x: Rows, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    owner, column = x.flat(rows)
    return np.bincount(owner, weights[column], minlength=len(rows)) + weights[-1]


def fit_calibration(columns: np.ndarray, y: np.ndarray, steps: int = 400) -> np.ndarray:
    """Logistic weights over a few margins, bias last."""
    full = np.hstack([columns, np.ones((len(y), 1))])
    weights = np.zeros(full.shape[1])
    for _ in range(steps):  # Newton steps with a small ridge: at most a handful of weights
        p = 1 / (1 + np.exp(-np.clip(full @ weights, -30, 30)))
        hessian = (full * (p * (1 - p))[:, None]).T @ full + 1e-2 * np.eye(len(weights))
        move = np.linalg.solve(hessian, full.T @ (p - y) + 1e-2 * weights)
        weights -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return weights


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    cuts: np.ndarray
    length_cuts: np.ndarray
    word_weights: np.ndarray  # per bucket, zero for most
    cell_weights: np.ndarray
    text_bias: float
    meta_weights: np.ndarray
    blend: np.ndarray  # text margin, metadata margin, bias

    def text_margins(self, buckets: np.ndarray, bounds: np.ndarray, shape: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(shape)), np.diff(bounds))
        heavy = self.word_weights[buckets] != 0
        pairs = np.unique(owner[heavy] * BUCKETS + buckets[heavy])
        words = np.bincount(pairs // BUCKETS, self.word_weights[pairs % BUCKETS], minlength=len(shape))
        return words + self.cell_weights[cells(shape, self.cuts)].sum(axis=1) + self.text_bias

    def meta_margins(self, columns: np.ndarray) -> np.ndarray:
        return self.meta_weights[columns].sum(axis=1) + self.meta_weights[-1]


def choose_words(buckets: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Buckets whose use differs most between good and bad documents."""
    use = np.zeros((2, BUCKETS))
    for b, g in zip(buckets, good):
        use[int(g), b] += 1
    n = np.array([(~good).sum(), good.sum()], dtype=np.float64)
    rate, total = use / n[:, None], use.sum(axis=0)
    mean = total / n.sum()
    z = np.abs(rate[0] - rate[1]) / np.sqrt(np.maximum(mean * (1 - mean), 1e-12) * (1 / n).sum())
    z[total < LEAST_USE] = 0
    order = np.argsort(-z, kind="stable")[:CHOSEN]
    return np.sort(order[z[order] >= LEAST_Z])


def co_train(sample, rounds: int = ROUNDS) -> Model | None:
    """The model of a pandas frame of ``sampled_features``; none without labels of both kinds."""
    labelled = sample["good"].notna().to_numpy()
    good = sample["good"].where(labelled, False).astype(bool).to_numpy()
    turn, held = shingles.mix(sample["doc_id"].to_numpy().astype(np.uint64)), np.zeros(len(sample), dtype=bool)
    for kind in (True, False):
        mine = np.flatnonzero(labelled & (good == kind))
        if len(mine) < 2:
            return None
        held[mine[np.argsort(turn[mine], kind="stable")][1::4]] = True
    train = labelled & ~held
    shape = np.vstack(sample["shape"].to_numpy())
    quantiles = np.linspace(0, 1, CUTS + 2)[1:-1]
    cuts = np.quantile(shape[labelled], quantiles, axis=0).T
    bad = shape[train & ~good]
    cuts = np.sort(np.hstack([cuts, np.quantile(bad, quantiles, axis=0).T]), axis=1)
    chars = sample["n_chars"].fillna(-1).to_numpy(dtype=np.float64)
    length_cuts = np.quantile(chars, quantiles)
    buckets = list(sample["buckets"])
    chosen = choose_words([buckets[i] for i in np.flatnonzero(train)], good[train])
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    at = cells(shape, cuts) + len(chosen)
    text = Rows([np.concatenate([place[b][place[b] >= 0], c]) for b, c in zip(buckets, at)])
    text_width = len(chosen) + shape.shape[1] * (cuts.shape[1] + 1)
    clean = lambda s: [None if v is None or v != v else v for v in s]
    meta = Rows(list(metadata_columns(clean(sample["lang"]), clean(sample["source"]), clean(sample["n_chars"]), length_cuts)))
    views = ((text, text_width), (meta, META))
    rows = [np.flatnonzero(train), np.flatnonzero(train)]
    label = [good.copy(), good.copy()]
    pool = np.flatnonzero(~labelled)
    held_rows = np.flatnonzero(held)
    for turn in range(rounds + 1):
        weights = [fit_logistic(x, r, y[r].astype(float), w) for (x, w), r, y in zip(views, rows, label)]
        if turn == rounds:
            break
        for mine, other in ((0, 1), (1, 0)):
            x = views[mine][0]
            scale = fit_calibration(margins(x, held_rows, weights[mine])[:, None], good[held].astype(float))
            free = np.setdiff1d(pool, rows[other])
            sure = sigmoid(margins(x, free, weights[mine]) * scale[0] + scale[1])
            for kind, p in ((True, sure), (False, 1 - sure)):
                best = np.argsort(-p, kind="stable")[:PER_ROUND]
                new = free[best[p[best] >= SURE]]
                label[other][new] = kind
                rows[other] = np.concatenate([rows[other], new])
    both = np.stack([margins(x, held_rows, w) for (x, _), w in zip(views, weights)], axis=1)
    words = np.zeros(BUCKETS)
    words[chosen] = weights[0][: len(chosen)]
    return Model(
        cuts, length_cuts, words, weights[0][len(chosen) : -1], float(weights[0][-1]), weights[1],
        fit_calibration(both, good[held].astype(float)),
    )


def judged(labels: DataFrame) -> DataFrame:
    """``(doc_id, good)`` from ``labels (doc_id, quality, toxic)``; a null in either is no label."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return labels.groupBy("doc_id").agg(F.min(good).alias("good")).where("good IS NOT NULL AND doc_id IS NOT NULL")


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    ship_package(docs.sparkSession)
    known = judged(labels)
    turn = F.xxhash64("doc_id")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chosen = ids.join(known, "doc_id").orderBy(turn, "doc_id").limit(labelled)
    others = ids.join(known, "doc_id", "left_anti").orderBy(turn, "doc_id").limit(pool).withColumn("good", F.lit(None).cast("boolean"))
    # At most labelled + pool ids.
    sample = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.col("n_chars").cast("long").alias("n_chars"), "text"
    ).join(F.broadcast(chosen.union(others)), "doc_id")
    frame = as_frame(sampled_features(sample).toArrow())
    return co_train(frame) if len(frame) else None


def as_frame(table: pa.Table) -> pd.DataFrame:
    """The sample by id, each id once; buckets and shapes are views of two flat arrays and no Python numbers."""
    table = table.combine_chunks()
    if not len(table):
        return pd.DataFrame({"doc_id": []})
    views = {}
    for name in ("buckets", "shape"):
        lists = table.column(name).combine_chunks()
        views[name] = np.split(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())[:-1])
    frame = table.drop_columns(["buckets", "shape"]).to_pandas().assign(place=np.arange(len(table)))
    frame = frame.drop_duplicates("doc_id").sort_values("doc_id").reset_index(drop=True)
    return frame.assign(**{name: [v[i] for i in frame["place"]] for name, v in views.items()})


def score(docs: DataFrame, model: Model | None, add: str | None = None) -> DataFrame:
    """``doc_id, p_good, p_text, p_meta`` of every document, or all its columns and the probability under the name
    ``add``."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # a few MB, fixed by the number of buckets
    columns = docs.columns if add else ["doc_id"]

    def run(batches):
        from labelloom.llm import cotrain as c
        from labelloom.llm import shingles as s

        model = shared.value
        for batch in batches:
            for at, texts in s.slices(batch.column("text"), c.SLICE_BYTES):
                part = batch.slice(at, len(texts))
                n = len(texts)
                text = meta = good = np.full(n, 0.5)
                if model is not None:
                    tm = model.text_margins(*c.text_features(texts))
                    lists = (part.column(x).to_pylist() for x in ("lang", "source", "n_chars"))
                    mm = model.meta_margins(c.metadata_columns(*lists, model.length_cuts))
                    text, meta = c.sigmoid(tm), c.sigmoid(mm)
                    good = c.sigmoid(tm * model.blend[0] + mm * model.blend[1] + model.blend[2])
                out = {name: part.column(name) for name in columns}
                out[add or "p_good"] = pa.array(good)
                if not add:
                    out |= {"p_text": pa.array(text), "p_meta": pa.array(meta)}
                yield pa.RecordBatch.from_pydict(out)

    needed = list(dict.fromkeys([*columns, "text", "lang", "source", "n_chars"]))
    schema = docs.select(*columns).withColumn(add or "p_good", F.lit(0.0))
    if not add:
        schema = schema.withColumns({"p_text": F.lit(0.0), "p_meta": F.lit(0.0)})
    return docs.select(*needed).mapInArrow(run, schema.schema)
