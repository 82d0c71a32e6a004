"""Token ids in patched frame-of-reference files.

A file holds whole documents in ascending order of their id: a header, the documents' ids and lengths, an index of
block starts, then blocks of ``BLOCK`` ids. A block subtracts its minimum and packs all offsets at the width that
``PERCENTILE`` of them fit in; the others are kept in full in the block's exception list and leave zeros behind.

Layout, little-endian: ``TIDS``, version u32, documents u64, ids u64, blocks u64; document ids i64 each; document
lengths u64 each; block starts u64 each (bytes from the end of the index), one more for the end; blocks. A block is
minimum u32, width u8, exceptions u16, packed words u64 each, exception places u16 each, exception values u32 each.

Documents are sorted by range, so a task writes the files of one stretch of ids and no task sees more than its
stretch. Every try of a task writes under names of its own; only those in the table of written files are read, so a
lost executor leaves unread files at worst.

Defined cases: a null or empty text has no ids but the end id; repeated ids follow each other in order of text; a null
document id comes first and is stored as the least 64-bit number; an empty table gives no files and no rows; other
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.session import new_path, ship_package, stage

MAGIC, VERSION = b"TIDS", 1
HEAD = struct.Struct("<4sIQQQ")
BLOCK_HEAD = struct.Struct("<IBH")
BLOCK, PERCENTILE = 512, 90
BLOCKS_AT_ONCE = 512
FILE_IDS = 2_000_000
NO_ID = -(2**63)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below ``2**width`` as rows of 64-bit words; the row length is a multiple of 64."""
    lanes = values.reshape(len(values), -1, 64).astype(np.uint64)
    out = np.zeros((*lanes.shape[:2], width), dtype=np.uint64)
    for i in range(64 if width else 0):
        word, shift = divmod(i * width, 64)
        out[:, :, word] |= lanes[:, :, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= lanes[:, :, i] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)


def unpack(words: np.ndarray, width: int, size: int) -> np.ndarray:
    if not width:
        return np.zeros((len(words), size), dtype=np.uint64)
    packed = words.reshape(len(words), -1, width)
    out = np.empty((*packed.shape[:2], 64), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = packed[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (packed[:, :, word + 1] << np.uint64(64 - shift))
        out[:, :, i] = value & mask
    return out.reshape(len(words), -1)


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Block starts (one more than blocks) and the blocks' bytes; some hundred blocks at a time to save memory."""
    step = BLOCKS_AT_ONCE * block
    pieces = [p for a in range(0, len(ids), step) for p in _encode_some(ids[a : a + step], block, percentile)]
    return np.cumsum([0, *map(len, pieces)]).astype("<u8"), b"".join(pieces)


def _encode_some(ids: np.ndarray, block: int, percentile: int) -> list[bytes]:
    count = -(-len(ids) // block)
    padded = np.full(count * block, ids[-1], dtype=np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(count, block)
    least = rows.min(axis=1)
    offsets = rows - least[:, None]
    widths = np.frexp(offsets.astype(np.float64))[1].astype(np.uint8)
    place = -(-block * percentile // 100) - 1  # widths of this many are covered
    chosen = np.partition(widths, place, axis=1)[:, place]
    beyond = widths > chosen[:, None]
    packed: list = [b""] * count
    for width in np.unique(chosen).tolist():
        here = np.flatnonzero(chosen == width)
        words = pack(np.where(beyond[here], np.uint32(0), offsets[here]), width)
        for i, row in zip(here.tolist(), words):
            packed[i] = row.tobytes()
    owner, at = np.nonzero(beyond)
    bounds = np.searchsorted(owner, np.arange(count + 1))
    at, values = at.astype("<u2"), offsets[beyond].astype("<u4")
    return [
        BLOCK_HEAD.pack(int(m), int(w), int(b - a)) + body + at[a:b].tobytes() + values[a:b].tobytes()
        for m, w, body, a, b in zip(least, chosen, packed, bounds, bounds[1:])
    ]


def decode_blocks(data: bytes | memoryview, starts: np.ndarray, count: int, block: int = BLOCK) -> np.ndarray:
    """The first ``count`` ids of the blocks that begin at ``starts``; any run of the index will do."""
    out = np.empty(count, dtype=np.uint32)
    for a in range(0, len(starts) - 1, BLOCKS_AT_ONCE):
        room = out[a * block : (a + BLOCKS_AT_ONCE) * block]
        room[:] = _decode_some(data, starts[a : a + BLOCKS_AT_ONCE + 1], block)[: len(room)]
    return out


def _decode_some(data: bytes | memoryview, starts: np.ndarray, block: int) -> np.ndarray:
    n = len(starts) - 1
    heads = [BLOCK_HEAD.unpack_from(data, s) for s in starts[:-1].tolist()]
    out = np.empty((n, block), dtype=np.uint32)
    widths = np.array([h[1] for h in heads], dtype=np.int64)
    for width in np.unique(widths).tolist():
        here = np.flatnonzero(widths == width)
        size = block // 64 * width
        words = [np.frombuffer(data, "<u8", size, int(starts[i]) + BLOCK_HEAD.size) for i in here]
        out[here] = unpack(np.stack(words), width, block)
    for i, (least, width, exceptions) in enumerate(heads):
        if exceptions:
            at = int(starts[i]) + BLOCK_HEAD.size + 8 * (block // 64) * width
            places = np.frombuffer(data, "<u2", exceptions, at)
            out[i, places] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
        out[i] += np.uint32(least)
    return out.reshape(-1)


def encode_file(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    starts, body = encode_blocks(ids)
    head = HEAD.pack(MAGIC, VERSION, len(doc_ids), len(ids), len(starts) - 1)
    return b"".join([head, doc_ids.astype("<i8").tobytes(), lengths.astype("<u8").tobytes(), starts.tobytes(), body])


def decode_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their lengths, and all ids."""
    magic, version, documents, count, blocks = HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token file")
    at = HEAD.size
    doc_ids = np.frombuffer(data, "<i8", documents, at)
    lengths = np.frombuffer(data, "<u8", documents, at + 8 * documents).astype(np.int64)
    starts = np.frombuffer(data, "<u8", blocks + 1, at + 16 * documents)
    body = memoryview(data)[at + 16 * documents + 8 * (blocks + 1) :]
    return doc_ids, lengths, decode_blocks(body, starts, count)


def write_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode ``docs (doc_id, text)`` and write them in ascending order; the table of files, in no order.

    Its rows are ``(part, seq, name, documents, ids)``; part and seq give the files' order. The caller must store it:
    computing it again writes other files.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        from labelloom.llm.bpe import encoded_slices, load
        from labelloom.llm.pfor import NO_ID, encode_file

        bpe, part, seq, held = load(tokenizer, True), TaskContext.get().partitionId(), 0, []
        store, root = FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)

        def flush():
            doc_ids, lengths, ids = (np.concatenate(x) for x in zip(*held))
            name = f"ids-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.tid"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(encode_file(doc_ids, lengths, ids))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "name": [name], "documents": [len(doc_ids)], "ids": [len(ids)]}
            )

        for batch in batches:
            for doc_ids, ids, bounds in encoded_slices(batch, bpe):
                closed = np.insert(ids, bounds[1:], end_id)
                held.append((pc.fill_null(doc_ids, NO_ID).to_numpy(), np.diff(bounds) + 1, closed))
                if sum(len(h[2]) for h in held) >= file_ids:
                    yield flush()
                    seq, held = seq + 1, []
        if held:
            yield flush()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return ordered.mapInArrow(run, "part long, seq long, name string, documents long, ids long")


def read_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``(name, place, doc_id, local_start, n_tokens, ids_crc32)`` of the listed files."""
    ship_package(spark)

    def run(batches):
        from labelloom.llm.pfor import NO_ID, decode_file

        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                doc_ids, lengths, ids = decode_file(content.as_buffer())
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "name": pa.array([name] * len(doc_ids)),
                        "doc_id": pa.array(doc_ids, mask=doc_ids == NO_ID),
                        "local_start": pa.array(ends - lengths),
                        "n_tokens": pa.array(lengths),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    found = spark.read.format("binaryFile").load(folder).select(F.substring_index("path", "/", -1).alias("name"), "content")
    listed = found.join(files.select("name"), "name", "left_semi")
    return listed.mapInArrow(run, "name string, doc_id long, local_start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``, read back from the files; start counts the ids of all files before."""
    spark = docs.sparkSession
    folder = new_path(spark, "token-files")
    files = stage(write_files(docs, tokenizer, end_id, folder), "token-file-table")
    # One row per file of some million ids: two windows, so that not even those meet in one task.
    in_part = Window.partitionBy("part").orderBy("seq")
    parts = files.groupBy("part").agg(F.sum("ids").alias("all_ids"))
    before = parts.withColumn("before", F.sum("all_ids").over(Window.orderBy("part")) - F.col("all_ids"))
    starts = files.join(before, "part").select(
        "name", (F.col("before") + F.sum("ids").over(in_part) - F.col("ids")).alias("base")
    )
    empty = files.isEmpty()
    if empty:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return (
        read_files(spark, folder, files)
        .join(starts, "name")
        .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )
