"""Models of many tags fitted together in passes over stored sample rows.

Rows are stored as blocks, each of one tag and one fold. A fit is a ``state`` per (tag, job). In a pass every block is
measured in its task against all active states of its tag; what it adds (gradients, histograms) is summed in the task
first, then per (tag, job), where the state takes its next step. One pass is one job for all tags; states that are
finished are not measured again. Nothing goes through the driver but the number of active states.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import ship_package, stage

BLOCK_ROWS = 512
STATE = "tag string, job string, active boolean, state binary"
_STATE = pa.schema([("tag", pa.string()), ("job", pa.string()), ("active", pa.bool_()), ("state", pa.binary())])
_PART = pa.schema([("tag", pa.string()), ("job", pa.string()), ("part", pa.binary())])
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
HELD = 64_000_000


@dataclass(frozen=True)
class Block:
    """Some sample rows of one tag and fold, by id."""

    fold: int
    ids: np.ndarray
    label: np.ndarray
    x: np.ndarray


def row_blocks(rows: DataFrame, sample_size: int, folds: int, kind: str = "f8", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(tag, fold, data)`` of ``(tag, id, label, fold, features ARRAY)``, at most about ``block_rows`` rows each.

    ``sample_size`` is the largest sample of a tag, which the sample's specification bounds.
    """
    parts = max(1, math.ceil(sample_size / folds / block_rows))

    def gather(key, table):
        table = table.sort_by("id")
        x = table.column("features").combine_chunks()
        flat = x.flatten().to_numpy(zero_copy_only=False)
        block = Block(
            key[1].as_py(),
            table.column("id").to_numpy(),
            table.column("label").to_numpy().astype(bool),
            flat.reshape(len(table), -1).astype(kind),
        )
        return pa.table({"tag": [key[0].as_py()], "fold": pa.array([block.fold], pa.int32()), "data": [pickle.dumps(block)]})

    ship_package(rows.sparkSession)
    dealt = rows.select("tag", "id", "label", F.col("fold").cast("int").alias("fold"), "features").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    )
    return dealt.groupBy("tag", "fold", "part").applyInArrow(gather, "tag string, fold int, data binary")


def states(jobs: DataFrame, start: Callable[[dict], Any]) -> DataFrame:
    """First states: ``start`` makes one of a row of ``jobs (tag, job, ...)``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = [(row["tag"], row["job"], True, pickle.dumps(start(row))) for row in batch.to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _STATE.types)], schema=_STATE)

    ship_package(jobs.sparkSession)
    return jobs.mapInArrow(run, STATE)


def measured(blocks: DataFrame, current: DataFrame, measure: Callable, add: Callable, weight: Callable) -> DataFrame:
    """``(tag, job, part)``: what the blocks add to each state, summed within a task as far as memory allows."""

    def run(batches):
        sums, held = {}, 0

        def flushed():
            rows = [(*key, pickle.dumps(part)) for key, part in sums.items()]
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _PART.types)], schema=_PART)

        for batch in batches:
            for row in batch.to_pylist():
                block = pickle.loads(row["data"])
                for entry in row["jobs"]:
                    part = measure(block, pickle.loads(entry["state"]))
                    if part is None:
                        continue
                    key = (row["tag"], entry["job"])
                    if key in sums:
                        sums[key] = add(sums[key], part)
                    else:
                        sums[key] = part
                        held += weight(part)
                if held > HELD:
                    yield from flushed()
                    sums, held = {}, 0
        yield from flushed()

    jobs = current.where("active").groupBy("tag").agg(F.collect_list(F.struct("job", "state")).alias("jobs"))
    here = blocks.select("tag", "data").join(jobs, "tag")
    return here.mapInArrow(run, "tag string, job string, part binary")


def advanced(blocks: DataFrame, current: DataFrame, measure: Callable, add: Callable, step: Callable, weight: Callable) -> DataFrame:
    """States after one pass; ``step(state, part)`` returns the next state and whether it stays active."""

    def move(key, left, right):
        state = left.column("state")[0].as_py()
        active = left.column("active")[0].as_py()
        if active:
            total = None
            for part in right.column("part").to_pylist():
                part = pickle.loads(part)
                total = part if total is None else add(total, part)
            found, active = step(pickle.loads(state), total)
            state = pickle.dumps(found)
        return pa.table([[key[0].as_py()], [key[1].as_py()], [active], [state]], schema=_STATE)

    parts = measured(blocks, current, measure, add, weight)
    return current.groupBy("tag", "job").cogroup(parts.groupBy("tag", "job")).applyInArrow(move, STATE)


def fitted(
    blocks: DataFrame,
    first: DataFrame,
    measure: Callable,
    add: Callable,
    step: Callable,
    most: int,
    weight: Callable = lambda part: 1_000_000,
    name: str = "states",
) -> DataFrame:
    """Final states, after at most ``most`` passes; ``blocks`` should be a stored table."""
    current = stage(first, name)
    for _ in range(most):
        if not current.where("active").limit(1).count():
            break
        current = stage(advanced(blocks, current, measure, add, step, weight), name)
    return current


def scored(blocks: DataFrame, current: DataFrame, score: Callable, schema: str) -> DataFrame:
    """Rows of ``score(tag, block, state)`` (tuples in the order of ``schema``) for every block and state of its tag."""

    kinds = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = pickle.loads(row["data"])
                found = [r for s in row["all"] for r in score(row["tag"], block, pickle.loads(s))]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds.types)], schema=kinds)

    every = current.groupBy("tag").agg(F.collect_list("state").alias("all"))
    return blocks.select("tag", "data").join(every, "tag").mapInArrow(run, schema)
