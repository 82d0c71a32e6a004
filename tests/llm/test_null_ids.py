"""Rows without an id, and null values in every other column, pass through every operator."""

import public_tokenizers

from labelloom.llm import bpe, cotrain, gru, oneperm, pfor, probminhash, secrets, tiling
from tests.llm.conftest import SCHEMA

PATH = public_tokenizers.path("word_bpe_49k.json")
ROWS = [
    (None, "some words without any id at all", None, None, None, None, None),
    (None, None, None, None, None, None, None),
    (4, None, None, None, None, None, None),
    (5, "some words without any id at all", "en", "s", 3, "x", 1),
]


def test_every_operator(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    bench = spark.createDataFrame([(None, "some words without any id"), (1, None), (2, "words without any id at")], "item_id long, text string")
    ids = sorted((r[0] is not None, r[0] or 0) for r in ROWS)

    def ids_of(frame):
        return sorted((r.doc_id is not None, r.doc_id or 0) for r in frame.collect())

    assert ids_of(secrets.redact(secrets.scan(docs))) == ids
    assert ids_of(bpe.encode_decode(docs, PATH)) == ids
    files = pfor.write_and_read(docs, PATH, 2).orderBy("start").collect()
    assert [r.doc_id for r in files] == [None, None, 4, 5] and [r.n_tokens for r in files][2] == 1
    assert ids_of(oneperm.with_next(docs)) == ids
    assert ids_of(gru.score(docs)) == ids
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert cotrain.fit(docs, labels) is None and ids_of(cotrain.score(docs, None)) == ids
    assert ids_of(probminhash.near_duplicates(docs)) == [(True, 4), (True, 5)]
    assert {(r.doc_id, r.item_id) for r in tiling.contaminated_pairs(docs, bench).collect()} == {(5, 2)}
