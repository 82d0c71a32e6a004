"""Words and word shingles of whole texts as 64-bit hashes, a batch of texts at a time.

A word is a maximal run of letters, digits and underscores in lower case. A text of at least ``size`` words has one
shingle per place; a shorter one that has words is a single shingle. Equal words have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BETWEEN = r"[^\p{L}\p{N}_]+"
FACTOR = 0x9E3779B97F4A7C15
SLICE_BYTES = 8_000_000
SIZE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits without visible pattern."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a batch, every text's words as places in that list, and where each text's begin."""
    split = pc.split_pattern_regex(pc.utf8_lower(texts), BETWEEN)
    coded = split.flatten().dictionary_encode()
    distinct, places = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    if "" in distinct:
        kept = places != distinct.index("")
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        places = places[kept]
    return distinct, places, bounds


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    distinct, places, bounds = split_words(texts)
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in distinct], dtype=np.uint64)[places], bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Rolling polynomial hashes of ``size`` words, in order, with every text's bounds."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64), np.zeros_like(bounds)
    rolled = np.zeros(n, dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(size - 1, dtype=np.uint64)])
    for i in range(size):
        rolled = rolled * np.uint64(FACTOR) + padded[i : i + n]
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(n) + size <= bounds[1:][owner]
    for doc in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        value = int(counts[doc])
        for w in words[bounds[doc] : bounds[doc + 1]].tolist():
            value = (value * FACTOR + w) & 0xFFFFFFFFFFFFFFFF
        rolled[bounds[doc]] = value
        whole[bounds[doc]] = True
    kept = np.concatenate([[0], np.cumsum(whole)])
    return mix(rolled[whole]), kept[bounds]


def inner_windows(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside the texts, each equal to the only shingle of a text of just those
    words, with every text's bounds."""
    n = max(len(words) - size + 1, 0)
    rolled = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        rolled = rolled * np.uint64(FACTOR) + words[i : i + n]
    inside = np.repeat(bounds[1:], np.diff(bounds))[:n] >= np.arange(n) + size
    kept = np.concatenate([[0], np.cumsum(inside)])
    return mix(rolled[inside]), kept[np.minimum(bounds, n)]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of about ``most`` bytes, with the place of their first text; nulls are empty texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield a, texts.slice(a, b - a)
