"""Encoding, decoding and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from labelloom.llm import bpe, pfor

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "", "İstanbul Σίσυφος ΑΣ", "á ́b", "x<|endoftext|>y<|startoftext|>", "<|ENDOFTEXT|>", "it's we'LL 'S''s",
    "  x\u0085y\x0bz\x1cq", "日本語 テキスト🙂🙂", "a" * 500, "=-" * 300 + "abc" * 200, "ẛ̣ ﬁ ſ K Å", "한국어 각",
    "١٢٣ ½ Ⅷ", "\x00\x01", "don’t can't", "ÀÉ Ã© ã© ß÷×",
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encode(coder, texts):
    ids, bounds = coder.encode_many(pa.array(texts, pa.large_string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


@pytest.mark.parametrize("by_library", [False, True])
def test_odd_texts(by_library):
    rng = random.Random(3)
    mixed = ["".join(rng.choice("abceinst'’ .,!<|>éßΣσİ́\n\t 19½-_ABZ🙂한ÀÃ©÷") for _ in range(rng.randrange(40))) for _ in range(800)]
    assert encode(bpe.WordBpe(PATH, by_library), ODD + mixed) == [ids_of(t) for t in ODD + mixed]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    coder = bpe.load(PATH)
    ids, bounds = coder.encode_many(pa.array([text], pa.large_string()))
    assert ids.tolist() == ids_of(text)
    assert coder.decode_many(ids, bounds)[0].as_py() == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_tables_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    coder = bpe.WordBpe(PATH)
    rng = random.Random(5)
    for _ in range(6):
        texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30)) for _ in range(3)]
        assert encode(coder, texts) == [ids_of(t) for t in texts]
    assert len(coder.chunks) <= 150 and len(coder.words) <= 150


def test_query_rows(docs, doc_rows):
    found = sorted(map(tuple, bpe.encode_decode(docs, PATH).collect()))
    expected = []
    for doc_id, text, *_ in doc_rows:
        ids = ids_of(text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, dtype="<u4").tobytes()
        expected.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert found == sorted(expected)
    assert bpe.encode_decode(docs.limit(0), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_blocks_round_trip(values):
    ids = np.array(values, dtype=np.uint32)
    data = pfor.encode_file(np.array([7]), np.array([len(ids)]), ids)
    assert np.array_equal(pfor.decode_file(data)[2], ids)


def test_part_of_the_index():
    ids = np.random.default_rng(0).integers(0, 49408, 5000).astype(np.uint32)
    starts, body = pfor.encode_blocks(ids)
    assert np.array_equal(pfor.decode_blocks(body, starts[3:6], 1024), ids[3 * 512 : 5 * 512])


def test_outliers_go_to_exceptions():
    ids = np.full(512, 1000, dtype=np.uint32)
    ids[::2] += 3
    ids[7] = 2**31
    starts, body = pfor.encode_blocks(ids)
    least, width, exceptions = pfor.BLOCK_HEAD.unpack_from(body, 0)
    assert (least, width, exceptions) == (1000, 2, 1)


def test_files_in_order(docs, doc_rows):
    found = sorted(map(tuple, pfor.write_and_read(docs, PATH, 2).collect()), key=lambda r: r[1])
    at, expected = 0, []
    for doc_id, text in sorted(((r[0], r[1] or "") for r in doc_rows)):
        ids = np.array([*ids_of(text), 2], dtype="<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert found == expected
    assert pfor.write_and_read(docs.limit(0), PATH, 2).count() == 0
