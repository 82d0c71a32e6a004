"""Question CSV of any file size, read by many tasks although records hold line breaks.

A file is scanned as lines in byte ranges. Whether a line starts inside a quoted field is the parity of the quotes
before it (a doubled quote counts twice and changes nothing), so two passes suffice:

1. quotes are counted per range, which moves one row a range; their prefix sums say how each range starts;
2. each range puts its lines together to records in its task. What it starts with before the first record end, and what
   it ends with after the last, are fragments, and only these meet by a shuffle. A record may lie over many ranges.

Records are parsed by Spark's CSV expression. Texts are not shuffled. Both passes see the same ranges, because the
settings that shape them are fixed meanwhile, and a range without a count is an error, not a loss.

Defined cases: fields with quotes must be quoted as a whole; records end at a line feed, with or without a carriage
return before it; empty lines between records are skipped; the first record of every file is its header; a last record
whose quote is never closed is kept as it is; empty files give no rows; null fields are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.session import ship_package, stage
from labelloom.sources.questions import QUESTION_SCHEMA

RANGE_BYTES = 128 << 20
# Ranges that may be sent to every task, some 40 bytes each; with more, lines are brought to their range by a shuffle.
SENT_RANGES = 200_000
PIECES = "record string, file long, start long, place int, header boolean"


@contextmanager
def _ranges_of(spark: SparkSession, range_bytes: int) -> Iterator[None]:
    fixed = {
        "spark.sql.files.maxPartitionBytes": str(range_bytes),
        "spark.sql.files.openCostInBytes": "4096",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {name: spark.conf.get(name, None) for name in fixed}
    for name, value in fixed.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    quotes = F.char_length("value") - F.char_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        quotes.alias("quotes"),
        "value",
    )


def range_starts(lines: DataFrame) -> DataFrame:
    """``(file, start, odd)``: whether a range starts inside a quoted field (1) or not (0)."""
    counted = lines.groupBy("file", "start").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).alias("odd"))


class _Range:
    """Lines of one range, put together; ``pieces`` are the lines of the record that is open."""

    def __init__(self, file: int, start: int, odd: int):
        self.file, self.start, self.odd = file, start, odd
        self.pieces: list[str] = []
        self.inherited = odd == 1
        self.wants_header = start == 0

    def _row(self, record: str, place: int | None) -> tuple:
        header = self.wants_header and not self.inherited and bool(record.strip("\r"))
        self.wants_header &= not header
        return record, self.file, self.start, place, header

    def add(self, lines: pa.Array, quotes: np.ndarray) -> Iterator[tuple]:
        """Records that end in these lines and the fragment that the range starts with (``place`` 0)."""
        after = (self.odd + np.cumsum(quotes)) % 2
        self.odd = int(after[-1])
        ends = np.flatnonzero(after == 0) + 1
        if not len(ends):
            self.pieces += lines.to_pylist()
            return
        first, last = int(ends[0]), int(ends[-1])
        yield self._row("\n".join(self.pieces + lines[:first].to_pylist()), 0 if self.inherited else None)
        self.inherited = False
        records = pa.ListArray.from_arrays(pa.array(ends - first, pa.int32()), lines[first:last])
        for record in pc.binary_join(records, "\n").to_pylist():
            yield self._row(record, None)
        self.pieces = lines[last:].to_pylist()

    def rest(self) -> Iterator[tuple]:
        """The fragment that the range ends with (``place`` 1), or all of it if a record covers it."""
        if self.pieces:
            yield self._row("\n".join(self.pieces), 0 if self.inherited else 1)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
    names = ("record", "file", "start", "place", "header")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(names))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        file, start, odd, quotes = (batch.column(c).to_numpy() for c in ("file", "start", "odd", "quotes"))
        lines = batch.column("value")
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        rows: list[tuple] = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)]):
            if b == a:
                continue
            if now is None or (now.file, now.start) != (file[a], start[a]):
                rows += now.rest() if now else ()
                now = _Range(int(file[a]), int(start[a]), int(odd[a]))
            rows += now.add(lines.slice(a, b - a), quotes[a:b])
        if rows:
            yield _batch(rows)
    rows = list(now.rest()) if now else []
    if rows:
        yield _batch(rows)


def csv_records(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, sent_ranges: int = SENT_RANGES
) -> DataFrame:
    """``(record)``: every record below the headers as one text, its line breaks included."""
    ship_package(spark)
    with _ranges_of(spark, range_bytes):
        lines = _lines(spark, path)
        ranges = stage(range_starts(lines), "csv-ranges")
        count = ranges.count()
        if count <= sent_ranges:
            joined = lines.join(F.broadcast(ranges), ["file", "start"], "left")
        else:
            # A number of partitions given by hand is not split again, so a range stays in one task.
            joined = lines.repartition(max(count // 4, 1), "file", "start").join(ranges, ["file", "start"], "left")
        known = F.coalesce("odd", F.raise_error(F.lit("a range of the file was not counted")).cast("long"))
        ordered = joined.sortWithinPartitions("file", "start", "at").select(
            "file", "start", known.alias("odd"), "quotes", "value"
        )
        pieces = stage(ordered.mapInArrow(_assemble, PIECES), "csv-pieces")
    whole = pieces.where("place IS NULL AND NOT header").select("record")
    # A tail opens a record; what covers or starts the ranges after it belongs to the same one.
    opened = Window.partitionBy("file").orderBy("start", "place")
    fragments = pieces.where("place IS NOT NULL").withColumn("number", F.sum("place").over(opened))
    merged = (
        fragments.groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"), F.bool_or("header").alias("header"))
        .where("NOT header")
        .select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    )
    return whole.unionByName(merged).select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def read_large_questions_csv(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, sent_ranges: int = SENT_RANGES
) -> DataFrame:
    """The rows of ``questions.read_questions_csv``, by as many tasks as the files have ranges."""
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    parsed = F.from_csv("record", QUESTION_SCHEMA, options)
    rows = csv_records(spark, path, range_bytes, sent_ranges).select(parsed.alias("q"))
    return rows.select("q.id", *[F.coalesce(F.col("q")[c], F.lit("")).alias(c) for c in ("title", "body", "tags")])
