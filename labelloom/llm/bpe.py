"""BPE encoding by speculation and verification, and decoding.

A word is first cut by greedy longest match over the vocabulary. Such a cut is the right one exactly when every
adjacent pair of its tokens, merged on its own, comes out as that pair: the first merge to cross a border would do so
in the pair as well. Pair verdicts are kept in a sorted table, and all pairs of all new words of a batch are looked up
at once; only words with a failing pair go through the exact merges. Encoded pieces are remembered per worker in a
table of bounded size.

Text is taken apart at blanks, tabs and line ends, which the tokenizer's normaliser treats as white space, so that no
token crosses them; special tokens are cut out of the raw text first, as the tokenizers library does.

Defined cases: a null text is an empty one and has no tokens; very long words use a heap for their merges and are not
remembered; repeated rows give equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import ship_package

WORD_END = "</w>"
REMEMBERED, LONGEST_REMEMBERED = 300_000, 48
SLICE_BYTES = 3_000_000
# Text whose normal form is its lower case and whose words Python's patterns find: ASCII and Latin-1 letters. Anything
# else is left to the library's normaliser and pre-tokenizer.
LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PLAIN = re.compile(f"[\x21-\x7e{LETTERS}]*")
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^a-z0-9{LETTERS}]+")


def byte_symbols() -> dict[int, str]:
    """The printable symbol of every byte: itself where printable, else the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}


SYMBOLS = byte_symbols()


class WordBpe:
    """A word-level BPE tokenizer read from a file of the tokenizers library."""

    def __init__(self, path: str, by_library: bool = False) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        self.library = Tokenizer.from_file(path)
        self.by_library = by_library
        self.ids: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        known = {i: t for t, i in self.ids.items()} | {i: t for t, i in special.items()}
        self.tokens = [known.get(i, "") for i in range(max(known) + 1)]
        self.longest = max(len(t.removesuffix(WORD_END)) for t in self.ids)
        self.sound: dict[str, bool] = {}
        self.pair_keys = np.empty(0, dtype=np.int64)
        self.pair_fits = np.empty(0, dtype=bool)
        self.words: dict[str, bytes] = {}
        self.is_end = np.array([t.endswith(WORD_END) for t in self.tokens])
        self.token_strings = pa.array(self.tokens, pa.string())
        self.chunks: dict[str, bytes] = {}

    # -- exact merging ------------------------------------------------------------------------------------------

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge the pair of least rank, leftmost first, until none is left."""
        ranks, inf = self.ranks, len(self.ranks)
        if len(symbols) > 64:
            return self._merged_long(symbols)
        symbols = list(symbols)
        found = [ranks.get(p, inf) for p in zip(symbols, symbols[1:])]
        while found:
            least = min(found)
            if least == inf:
                break
            i = found.index(least)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del found[i]
            if i < len(found):
                found[i] = ranks.get((symbols[i], symbols[i + 1]), inf)
            if i:
                found[i - 1] = ranks.get((symbols[i - 1], symbols[i]), inf)
        return symbols

    def _merged_long(self, symbols: list[str]) -> list[str]:
        ranks, n = self.ranks, len(symbols)
        part: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if j >= n or ranks.get((part[i], part[j])) != rank:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (pair := (part[i], part[after[i]])) in ranks:
                    heapq.heappush(heap, (ranks[pair], i))
            if before[i] >= 0 and (pair := (part[before[i]], part[i])) in ranks:
                heapq.heappush(heap, (ranks[pair], before[i]))
        return [p for p in part if p is not None]

    @staticmethod
    def symbols(token: str) -> list[str]:
        body = token.removesuffix(WORD_END)
        if body != token:
            return [*body[:-1], body[-1] + WORD_END]
        return list(token)

    # -- speculation and verification -----------------------------------------------------------------------------

    def _is_sound(self, token: str) -> bool:
        """Whether the merges build ``token`` from its own symbols; others must not be proposed."""
        known = self.sound.get(token)
        if known is None:
            known = self.sound[token] = token in self.ids and self.merged(self.symbols(token)) == [token]
        return known

    def proposed(self, word: str) -> list[int] | None:
        """Greedy longest match; none if some place has no token."""
        out, at, n = [], 0, len(word)
        ids, longest, sound = self.ids, self.longest, self.sound
        while at < n:
            for end in range(min(n, at + longest), at, -1):
                token = word[at:end] if end < n else word[at:] + WORD_END
                if token in ids and (sound.get(token) or self._is_sound(token)):
                    out.append(ids[token])
                    at = end
                    break
            else:
                return None
        return out

    def pairs_fit(self, keys: np.ndarray) -> np.ndarray:
        """Verdicts of pair keys ``left << 20 | right``; pairs not met before are merged once and kept."""
        asked, back = np.unique(keys, return_inverse=True)
        fresh = asked[~np.isin(asked, self.pair_keys, assume_unique=True)]
        if len(fresh):
            tokens = self.tokens
            fits = np.empty(len(fresh), dtype=bool)
            for n, key in enumerate(fresh.tolist()):
                left, right = tokens[key >> 20], tokens[key & 0xFFFFF]
                fits[n] = self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
            every = np.concatenate([self.pair_keys, fresh])
            order = np.argsort(every)
            self.pair_keys = every[order]
            self.pair_fits = np.concatenate([self.pair_fits, fits])[order]
        return self.pair_fits[np.searchsorted(self.pair_keys, asked)][back]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Token ids of distinct words (already normalised and in byte symbols)."""
        proposals = [self.proposed(w) for w in words]
        sizes = np.array([len(p or ()) for p in proposals], dtype=np.int64)
        flat = np.array([t for p in proposals for t in p or ()], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        wrong = np.array([p is None for p in proposals], dtype=bool)
        if len(flat) > 1:
            inside = owner[1:] == owner[:-1]
            fits = self.pairs_fit((flat[:-1][inside] << 20) | flat[1:][inside])
            wrong[owner[1:][inside][~fits]] = True
        raw, bounds = flat.astype("<u4").tobytes(), [0, *(4 * np.cumsum(sizes)).tolist()]
        out = {w: raw[bounds[i] : bounds[i + 1]] for i, w in enumerate(words)}
        for i in np.flatnonzero(wrong).tolist():
            exact = [self.ids[t] for t in self.merged(self.symbols(words[i] + WORD_END))]
            out[words[i]] = np.array(exact, dtype="<u4").tobytes()
        return out

    # -- text -----------------------------------------------------------------------------------------------------

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without blanks, as little-endian 32-bit integers, by speculation and verification."""
        rows: list[list[str | bytes]] = []
        for chunk in chunks:
            if PLAIN.fullmatch(chunk) and "<|" not in chunk:
                found = PIECE.findall(chunk.lower())
                rows.append(found if chunk.isascii() else ["".join(map(SYMBOLS.__getitem__, p.encode())) for p in found])
                continue
            row: list[str | bytes] = []
            for cut in self.special_cut.split(chunk):
                if cut in self.special:
                    row.append(self.special[cut].to_bytes(4, "little"))
                elif cut:
                    cleaned = self.library.normalizer.normalize_str(cut)
                    row += [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(cleaned)]
            rows.append(row)
        known = self._known({p for row in rows for p in row if isinstance(p, str)}, self.encode_words)
        return [b"".join([known[p] if isinstance(p, str) else p for p in row]) for row in rows]

    def learn_by_library(self, chunks: list[str]) -> list[bytes]:
        """The same by the tokenizers library: distinct words go through it in long lines, where every word's last
        token bears the word-end mark; chunks beyond plain Latin text go through it as they are."""
        rows = [PIECE.findall(c.lower()) if PLAIN.fullmatch(c) and "<|" not in c else None for c in chunks]
        known = self._known({p for row in rows if row for p in row}, self._library_words)
        other = [c for c, row in zip(chunks, rows) if row is None]
        encoded = iter(self.library.encode_batch_fast(other, add_special_tokens=False) if other else ())
        return [
            np.array(next(encoded).ids, dtype="<u4").tobytes() if row is None else b"".join([known[p] for p in row])
            for row in rows
        ]

    def _library_words(self, words: list[str]) -> dict[str, bytes]:
        out = {}
        lines = [words[i : i + 4096] for i in range(0, len(words), 4096)]
        for line, found in zip(lines, self.library.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(line):
                raise ValueError("a word was cut by the tokenizer")
            raw, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
            out |= {w: raw[bounds[i] : bounds[i + 1]] for i, w in enumerate(line)}
        return out

    def _known(self, wanted: set[str], encode) -> dict[str, bytes]:
        fresh = encode([w for w in wanted if w not in self.words])
        long = {w: t for w, t in fresh.items() if len(w) > LONGEST_REMEMBERED}
        _trim(self.words, REMEMBERED - len(fresh), wanted)
        self.words |= {w: t for w, t in fresh.items() if w not in long} if long else fresh
        return self.words | long if long else self.words

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one bound more than texts)."""
        for blank in "\t\n\r":
            texts = pc.replace_substring(texts, blank, " ")
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        chunks, place = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found = list(map(self.chunks.get, chunks))
        missing = [i for i, v in enumerate(found) if v is None]
        if missing:
            fresh = [chunks[i] for i in missing]
            values = (self.learn_by_library if self.by_library else self.learn)(fresh)
            for i, v in zip(missing, values):
                found[i] = v
            _trim(self.chunks, REMEMBERED - len(fresh))
            self.chunks |= {c: v for c, v in zip(fresh, values) if len(c) <= LONGEST_REMEMBERED}
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        begins = np.cumsum(sizes) - sizes
        n = sizes[place]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.arange(total) + np.repeat(begins[place] - ends + n, n)]
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids, bounds

    def decode_many(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Token strings with a blank between, which is what a tokenizer without a decoder gives."""
        strings = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), self.token_strings.take(pa.array(ids)))
        return pc.binary_join(strings, " ")


def _trim(table: dict, most: int, keep: set[str] | None = None) -> None:
    """Forget the latest entries beyond half of the limit: the frequent ones were met first."""
    if len(table) > max(0, most):
        for key in list(table)[REMEMBERED // 2 :]:
            if keep is None or key not in keep:
                del table[key]


@lru_cache(maxsize=2)
def load(path: str, by_library: bool = False) -> WordBpe:
    """One tokenizer per worker and file; its tables outlive the task."""
    return WordBpe(path, by_library)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of about ``most`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield texts.slice(a, b - a)


def encoded_slices(batch: pa.RecordBatch, bpe: WordBpe):
    """``(doc ids, ids, bounds)`` for runs of a batch's rows."""
    texts, at = pc.fill_null(batch.column("text").cast(pa.large_string()), ""), 0
    for part in slices(texts):
        yield batch.column("doc_id").slice(at, len(part)), *bpe.encode_many(part)
        at += len(part)


def encode_decode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row of ``docs (doc_id, text)``; with ``keep_ids`` the ids
    (little-endian 32-bit) and the decoded text too."""
    ship_package(docs.sparkSession)

    def run(batches):
        from labelloom.llm.bpe import encoded_slices, load

        bpe = load(path)
        for batch in batches:
            for doc_ids, ids, bounds in encoded_slices(batch, bpe):
                decoded = bpe.decode_many(ids, bounds)
                raw = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                columns = {
                    "doc_id": doc_ids,
                    "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in decoded], pa.string()),
                }
                if keep_ids:
                    columns |= {"ids": pa.array(raw, pa.binary()), "decoded": decoded.cast(pa.string())}
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema + ", ids binary, decoded string" * keep_ids)
