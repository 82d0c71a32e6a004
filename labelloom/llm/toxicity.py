"""Toxicity by a weighted lexicon that is learned from labels and matched by Aho-Corasick.

Texts are folded first: compatibility forms, capitals, letters of other scripts that look Latin, invisible marks, and
digits or symbols inside words that stand for letters; ``l`` and ``i`` are one letter, since ``1`` stands for both. A
folded text is its words, each between blanks of its own.

The lexicon holds whole words and beginnings of words (3 to 10 letters). Of the labelled documents' distinct words it
counts how many stand in toxic and in clean documents; entries stay whose lower confidence bound of toxicity is a
multiple of the base rate and whose likelihood ratio is significant, at most ``ENTRIES`` of them. Of entries with equal
counts the longest stays, and an entry goes when a shorter one says as much. The weight is the log odds.

Phrases of two words are exceptions when an entry in them is harmless: ``EXCEPTIONS``, and those that labelled clean
documents use and toxic ones do not. They are longer patterns of the same automaton, which takes the leftmost longest
match, so a phrase hides the entry inside.

The weights of all matches are summed and normalised by the text's length; a logistic curve over these sums, fitted on
the labelled documents, gives the score from 0 to 1.

Fitting takes at most ``LABELLED`` documents in expectation, chosen by hash of the id, counts in Spark and brings
counts of at most ``ENTRIES`` entries and five numbers per labelled document to the driver. Scores are computed in
tasks over whole texts.

Defined cases: null texts are empty; texts without words have no match and the score of such texts; null labels are no
labels; documents with several label rows are toxic if any says so; repeated rows are scored alike; rows without an id
are scored and never learned from; without labelled documents of both kinds the lexicon is empty and every score is the
share of toxic labels (0 without labels); an empty table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.llm.common import fresh
from labelloom.session import ship_package, stage

LABELLED = 24_000
ENTRIES, PHRASES = 4096, 1024
SHORTEST, LONGEST = 3, 10
LEAST_USES, LEAST_RATIO, LEAST_LIFT, Z = 3, 24.0, 3.0, 1.96
FLAGGED = 0.3
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bag", "clown fish", "circus clown", "pond scum")

# Letters that look like a Latin one.
LOOKALIKES = dict(
    zip(
        "авеёікмнорстухѕјԁһӏɡɑαβεικνορτυχγ",
        "abeeikmhopctyxsjdhlgaabeiknoptuxy",
    )
)
INVISIBLE = "­​‌‍⁠﻿"
DIGITS = str.maketrans("0123456789", "oizeasgtbg")
SYMBOLS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}
_TABLE = str.maketrans(LOOKALIKES | dict.fromkeys(INVISIBLE))
_SYMBOL = re.compile(r"(?<![@$!|€\d])(?:[@$€]|(?<=[^\W_])[!|])(?=[^\W\d_])")
_MIXED = re.compile(r"[^\W_]*(?:[^\W\d_]\d|\d[^\W\d_])[^\W_]*")
_BETWEEN = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Folded words of a text, each with a blank before and after it."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        text = text.translate(_TABLE)
    text = _SYMBOL.sub(lambda m: SYMBOLS[m[0]], text)
    text = _MIXED.sub(lambda m: m[0].translate(DIGITS), text)
    text = _BETWEEN.sub("  ", text.replace("l", "i")).strip(" ")
    return f" {text} " if text else ""


def entries_of(word: str) -> list[str]:
    """Lexicon entries that a folded word can match: its beginnings and itself."""
    return [f" {word[:k]}" for k in range(SHORTEST, min(len(word), LONGEST + 1))] + [f" {word} "]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, ...] = ()
    prior: float = 0.0

    def automaton(self) -> ahocorasick.Automaton:
        """Entries with their weights, exceptions with none."""
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found


def matches(folded: str, automaton: ahocorasick.Automaton) -> Iterable[tuple[int, float]]:
    """Start and weight of the leftmost longest matches, without exceptions."""
    if not len(automaton):
        return
    for last, (size, weight) in automaton.iter_long(folded):
        if weight is not None:
            yield last + 1 - size, weight


def measures(folded: str, automaton: ahocorasick.Automaton) -> tuple[int, list[float]]:
    """Number of matches, and their weights summed and normalised by length."""
    weights = [w for _, w in matches(folded, automaton)]
    total, words = sum(weights), folded.count("  ") + bool(folded)
    return len(weights), [
        math.log1p(total),
        total / math.sqrt(words + 1),
        total / (words + 8),
        max(weights, default=0.0),
        math.log1p(words),
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> tuple[float, ...]:
    """Coefficients of the columns and the constant, by Newton's method on standardised columns."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = probability(z @ w)
        slope = z.T @ (p - y) + ridge * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return (*(w[:-1] / spread).tolist(), float(w[-1] - (w[:-1] * mean / spread).sum()))


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether a document's labels may not be learned from."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """``(toxic, folded)`` of labelled documents, ``most`` of them in expectation; staged."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    share = most / max(rows.count(), 1)
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches):
        from labelloom.llm import toxicity as t

        for batch in batches:
            folded = [t.fold(x or "") for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(folded, pa.string())], ["toxic", "folded"])

    ship_package(docs.sparkSession)
    joined = docs.select("doc_id", "text").dropDuplicates().join(rows, "doc_id").select("toxic", "text")
    return stage(joined.mapInArrow(run, "toxic boolean, folded string"), "toxic-sample")


def counted(sample: DataFrame, things_of) -> DataFrame:
    """``(thing, bad, good)``: toxic and clean documents with each of the things a folded text has."""

    def run(batches):
        for batch in batches:
            bad, good = Counter(), Counter()
            for toxic, folded in zip(batch.column("toxic").to_pylist(), batch.column("folded").to_pylist()):
                (bad if toxic else good).update(things_of(folded))
            things = list(bad | good)
            yield pa.RecordBatch.from_pydict(
                {
                    "thing": pa.array(things, pa.string()),
                    "bad": pa.array([bad[x] for x in things], pa.int64()),
                    "good": pa.array([good[x] for x in things], pa.int64()),
                }
            )

    parts = sample.mapInArrow(run, "thing string, bad long, good long")
    return parts.groupBy("thing").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def lexicon(sample: DataFrame, most: int = ENTRIES) -> dict[str, float]:
    """Weights of the chosen entries."""
    words = stage(counted(sample, lambda folded: set(folded.split())), "toxic-words")
    bad, good = words.agg(F.sum("bad"), F.sum("good")).first()
    if not bad or not good:
        return {}
    base = bad / (bad + good)
    size = F.char_length("thing")
    begins = F.transform(
        F.sequence(F.lit(SHORTEST), F.greatest(F.least(size - 1, F.lit(LONGEST)), F.lit(SHORTEST))),
        lambda k: F.concat(F.lit(" "), F.substring("thing", F.lit(1), k)),
    )
    entry = F.concat(F.when(size > SHORTEST, begins).otherwise(F.array().cast("array<string>")), F.array(F.concat(F.lit(" "), "thing", F.lit(" "))))
    counts = words.select(F.explode(entry).alias("entry"), "bad", "good").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    n, p = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    low = (p + Z * Z / 2 / n - Z * F.sqrt(p * (1 - p) / n + Z * Z / 4 / n / n)) / (1 + Z * Z / n)
    least = min(LEAST_LIFT * base, 0.5)
    gain = F.when(F.col("good") > 0, F.col("good") * F.ln(F.col("good") / (n * (1 - base)))).otherwise(0.0)
    ratio = 2 * (F.col("bad") * F.ln(F.col("bad") / (n * base)) + gain)
    chosen = counts.where((F.col("bad") >= LEAST_USES) & (low > least)).withColumn("ratio", ratio)
    rows = chosen.where(F.col("ratio") > LEAST_RATIO).orderBy(F.desc("ratio"), F.desc(F.length("entry")), "entry").limit(most).collect()
    left = pruned({r.entry: (r.ratio, r.bad, r.good) for r in rows}, bad, good)
    return {
        e: odds(x, y, bad, good) for e, x, y in left if x >= LEAST_USES and lower_bound(x, x + y) > least
    }


def odds(bad: int, good: int, all_bad: int, all_good: int) -> float:
    return math.log((bad + 0.5) / (all_bad + 1)) - math.log((good + 0.5) / (all_good + 1))


def lower_bound(bad: int, n: int) -> float:
    """Wilson's lower bound of a share."""
    p = bad / n
    return (p + Z * Z / 2 / n - Z * math.sqrt(p * (1 - p) / n + Z * Z / 4 / n / n)) / (1 + Z * Z / n)


def pruned(found: dict[str, tuple[float, int, int]], all_bad: int, all_good: int) -> list[tuple[str, int, int]]:
    """Entries that neither a longer one equals nor a shorter one makes needless, with the uses no longer one has."""

    def begins(entry):
        return [entry[:k] for k in range(SHORTEST + 1, len(entry))]

    equalled = {b for e, (_, *uses) in found.items() for b in begins(e) if b in found and [*found[b][1:]] == uses}
    left = {e: v for e, v in found.items() if e not in equalled}
    says = {e: odds(x, y, all_bad, all_good) for e, (_, x, y) in left.items()}
    kept = {
        e for e in left if not any(b in left and left[b][0] >= left[e][0] and says[b] >= says[e] - 0.7 for b in begins(e))
    }
    own = {e: [*left[e][1:]] for e in kept}
    for e in kept:
        inside = [b for b in begins(e) if b in kept]
        if inside:
            for i in (0, 1):
                own[inside[-1]][i] -= left[e][1 + i]
    return [(e, *own[e]) for e in sorted(kept, key=lambda e: (-left[e][0], e))]


def phrases_of(folded: str, automaton: ahocorasick.Automaton) -> set[str]:
    """Two-word phrases around the matches of a folded text."""
    found = set()
    for start, _ in matches(folded, automaton):
        end = folded.find(" ", start + 1)
        word = folded[start + 1 : end]
        after = folded[end + 2 : folded.find(" ", end + 2)] if end + 2 < len(folded) else ""
        before = folded[folded.rfind(" ", 0, start - 1) + 1 : start - 1] if start > 1 else ""
        found |= {f" {word}  {after} "} if after else set()
        found |= {f" {before}  {word} "} if before else set()
    return found


def exceptions(sample: DataFrame, weights: dict[str, float], most: int = PHRASES) -> list[str]:
    """Phrases that hold an entry and stand in clean labelled documents only."""
    if not weights:
        return []
    rows = counted(sample, _Lazy(weights)).where((F.col("bad") == 0) & (F.col("good") >= LEAST_USES))
    return [r.thing for r in rows.orderBy(F.desc("good"), "thing").limit(most).collect()]


class _Lazy:
    """Phrases of a text by an automaton that is built once in every task."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights, self.made = weights, None

    def __call__(self, folded: str) -> set[str]:
        self.made = self.made or Model(self.weights).automaton()
        return phrases_of(folded, self.made)


def fit(docs: DataFrame, labels: DataFrame, *, most: int = LABELLED, harmless: Iterable[str] = EXCEPTIONS) -> Model:
    """Lexicon, exceptions and curve from the labels of ``labels (doc_id, toxic)`` that may be learned from."""
    sample = training_rows(docs, labels, most)
    bad, all_ = sample.agg(F.count_if("toxic"), F.count("*")).first()
    prior = bad / all_ if all_ else 0.0
    weights = lexicon(sample) if 0 < bad < all_ else {}
    if not weights:
        return Model(prior=prior)
    model = Model(weights, tuple(sorted({*(fold(p) for p in harmless), *exceptions(sample, weights)})), (), prior)

    def run(batches):
        from labelloom.llm import toxicity as t

        automaton = model.automaton()
        for batch in batches:
            rows = [t.measures(x, automaton)[1] for x in batch.column("folded").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"])

    # A row is five numbers, and there are ``most`` of them in expectation.
    rows = sample.mapInArrow(run, "toxic boolean, x array<double>").toArrow().combine_chunks()
    x = np.stack(rows.column("x").to_numpy(zero_copy_only=False)) if len(rows) else np.empty((0, 5))
    y = rows.column("toxic").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # sums do not depend on how rows arrive
    return Model(weights, model.exceptions, fit_logistic(x[order], y[order]), prior)


def score(docs: DataFrame, model: Model, *, name: str = "score", hits: str = "hits") -> DataFrame:
    """``docs`` with the score and the number of matches of every text, under names that are free."""
    name, hits = fresh(docs, name), fresh(docs, hits)
    at = docs.columns.index("text")

    def run(batches):
        from labelloom.llm import toxicity as t

        automaton = model.automaton()
        for batch in batches:
            found = [t.measures(t.fold(x or ""), automaton) for x in batch.column(at).to_pylist()]
            if model.coefficients:
                x = np.array([m for _, m in found]).reshape(len(found), -1)
                scores = t.probability(x @ np.array(model.coefficients[:-1]) + model.coefficients[-1])
            else:
                scores = np.full(len(found), model.prior)
            more = [pa.array(scores, pa.float64()), pa.array([n for n, _ in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, name, hits])

    ship_package(docs.sparkSession)
    fields = [*docs.schema.fields, T.StructField(name, T.DoubleType()), T.StructField(hits, T.LongType())]
    return docs.mapInArrow(run, T.StructType(fields))
