"""Prefix trie of conversations: union-find over the shared depths of sorted neighbours.

A conversation is its turns in order (null turns first; ties of a turn by the md5 of role and text; null roles and texts
are empty). ``rebuilt`` puts the first turns of another conversation in place of a conversation's own; the trie is over
any table of turns.

1. ``along`` sorts all turns by range over (conversation, place), so that a conversation of any length is spread over
   partitions, and adds up along each one its depth, words and a rolling 128-bit hash of the turns so far. Partitions
   start at nothing; one row per partition tells the next where its first conversation stands.
2. Conversations are sorted by their paths. A path needs only the depths at which something branches off or ends, so
   its length is at most about the root of twice the number of all turns.
3. Neighbours in that order share a depth. In every run of neighbours these edges are taken in descending depth:
   components that meet at a depth become one branching node there, and a component that is deeper hangs below it as a
   child, whose numbers are then final. What touches the open ends of a run stays: a component whose neighbour across
   the end is unknown, and the nodes above it. This contracted forest, two spines, goes to the next run of the task and,
   in rounds of ``FAN`` neighbouring partitions, over the boundaries between them.
4. Nodes between two branchings have the members of the lower one; they are listed at the end, and their words come
   from a join on (conversation, depth).

Defined cases: rows without a ``conv_id`` belong to no conversation; repeated rows are turns of their own; an empty
table gives no rows; other columns are not read. The digest of the conversations that end at a node is made by a stream
over their sorted ids: constant memory, though a digest of one node cannot be spread over tasks.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import ship_package, stage

BASE = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xD6E8FEB86659FD93)
WORDS = r"[^\x20\x09-\x0D]+"
FAN = 32
SPAN = 4096
NOTHING = hashlib.sha256(b"").hexdigest()
STEP = "pid int, conv_id long, depth long, a long, b long, pa long, pb long, before long, last long, words long"
NODE = "conv_id long, depth long, a long, b long, top long, pa long, pb long, n long, children long, leaves long, saved long, above long"
NODE_NAMES = [x.split()[0] for x in NODE.split(", ")]


def head_length(conv_id: Column) -> Column:
    """How many turns of its group's first conversation a conversation starts with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, key, words)``: texts as keys, in narrow rows."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        key.alias("key"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depths, hashes and words along the sorted rows of one partition, each conversation from nothing."""
    pid = TaskContext.get().partitionId()
    conv, depth, a, b, words, last = None, 0, np.uint64(0), np.uint64(0), 0, 0
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        ids = batch.column("conv_id").to_numpy()
        count = batch.column("words").to_numpy().astype(np.int64)
        raw = np.frombuffer("".join(batch.column("key").to_pylist()).encode(), np.uint8)
        digits = np.where(raw < 97, raw - 48, raw - 87).reshape(n, 2, 16).astype(np.uint64)
        lanes = (digits << (np.arange(15, -1, -1, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)
        starts = np.concatenate([[True], ids[1:] != ids[:-1]])
        goes_on = conv is not None and ids[0] == conv
        first = np.flatnonzero(starts)
        owner = np.cumsum(starts) - 1
        place = np.arange(n) - first[owner]
        place[owner == 0] += depth if goes_on else 0

        def added(terms, before):
            """Running sums that start anew with each conversation."""
            total = np.cumsum(terms, dtype=terms.dtype)
            base = np.where(first > 0, total[first - 1], terms.dtype.type(0))
            out = total - base[owner]
            if goes_on:
                out[owner == 0] += before
            return out

        at = place.astype(np.uint64)
        sum_a = added(lanes[:, 0] * np.power(BASE, at), a)
        sum_b = added(lanes[:, 1] * np.power(OTHER, at), b)
        sum_w = added(count, np.int64(words))

        def shifted(values, before):
            out = np.concatenate([values[:1] * 0, values[:-1]])
            out[starts] = 0
            if goes_on:
                out[0] = before
            return out

        yield pa.RecordBatch.from_pydict(
            {
                "pid": pa.array(np.full(n, pid, dtype=np.int32)),
                "conv_id": batch.column("conv_id"),
                "depth": pa.array(place + 1),
                "a": pa.array(sum_a.view(np.int64)),
                "b": pa.array(sum_b.view(np.int64)),
                "pa": pa.array(shifted(sum_a, a).view(np.int64)),
                "pb": pa.array(shifted(sum_b, b).view(np.int64)),
                "before": pa.array(sum_w - count),
                "last": pa.array(shifted(count, last)),
                "words": pa.array(count),
                "key": batch.column("key"),
            }
        )
        conv, depth, a, b, words, last = ids[-1], int(place[-1]) + 1, sum_a[-1], sum_b[-1], int(sum_w[-1]), int(count[-1])


def carried(tails: list) -> dict[int, tuple]:
    """What stands before the first conversation of a partition, by partition, from one row of each in order."""
    found, before = {}, None
    for row in tails:
        end = row.end
        mine = (end.conv_id, end.depth, end.a, end.b, end.before + end.words, end.words)
        if before and row.least == before[0]:
            found[row.pid] = before
            if end.conv_id == before[0]:
                mine = joined(before, mine)
        before = mine
    return found


def joined(left: tuple, right: tuple) -> tuple:
    """State after two stretches of the same conversation."""
    conv, n, a, b, words, _ = left
    lane = lambda x, y, base: int((np.array([x]).view(np.uint64) + np.power(base, np.uint64([n])) * np.array([y]).view(np.uint64)).view(np.int64)[0])
    return (conv, n + right[1], lane(a, right[2], BASE), lane(b, right[3], OTHER), words + right[4], right[5])


def along(rows: DataFrame, *order: str) -> DataFrame:
    """``rows (conv_id, key, words, ...)`` with what has been added up along each conversation; staged."""
    ship_package(rows.sparkSession)
    dealt = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order).select("conv_id", "key", "words")
    local = stage(dealt.mapInArrow(_walk, STEP + ", key string"), "turns-along")
    end = F.max(F.struct("conv_id", "depth", "a", "b", "before", "words"))
    # One row per partition.
    tails = local.groupBy("pid").agg(F.min("conv_id").alias("least"), end.alias("end")).orderBy("pid").collect()
    before = carried(tails)
    if not before:
        return local

    def run(batches):
        for batch in batches:
            pids, ids = batch.column("pid").to_numpy(), batch.column("conv_id").to_numpy()
            columns = {c: np.array(batch.column(c)) for c in ("depth", "a", "b", "pa", "pb", "before", "last")}
            for pid in np.unique(pids).tolist():
                if pid not in before:
                    continue
                conv, n, a, b, words, last = before[pid]
                here = (pids == pid) & (ids == conv)
                columns["last"][here & (columns["depth"] == 1)] = last
                columns["depth"][here] += n
                columns["before"][here] += words
                for names, lane, base in ((("a", "pa"), a, BASE), (("b", "pb"), b, OTHER)):
                    for name in names:
                        value = columns[name][here].view(np.uint64) * np.power(base, np.uint64([n]))
                        columns[name][here] = (value + np.array([lane]).view(np.uint64)).view(np.int64)
            out = {c: pa.array(columns[c]) if c in columns else batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict(out)

    return local.mapInArrow(run, STEP + ", key string")


def rebuilt(turns: DataFrame, group: int = 20) -> tuple[DataFrame, DataFrame]:
    """Steps of the rebuilt conversations, and the ids of all, ``(conv_id)``.

    A conversation takes the first ``head_length`` turns of the conversation that its id rounds down to and drops as many of its own.
    """
    own = along(stage(turns, "turns"), "turn", "key")
    ids = own.where("depth = 1").select("conv_id")
    heads = own.where((F.col("conv_id") % group == 0) & (F.col("depth") <= 3))
    heads = heads.select(F.col("conv_id").alias("head_of"), "depth", "key", "words")
    length = head_length(F.col("conv_id"))
    taken = ids.where(length > 0).select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("head_of"))
    taken = taken.join(heads, "head_of").where(F.col("depth") <= length)
    first = taken.select("conv_id", F.lit(0).alias("part"), "depth", "key", "words")
    rest = own.where(F.col("depth") > length).select("conv_id", F.lit(1).alias("part"), "depth", "key", "words")
    return along(stage(first.unionByName(rest), "rebuilt"), "part", "depth"), ids


def paths(steps: DataFrame, ids: DataFrame) -> DataFrame:
    """``(conv_id, depth, a, b, words, last, path)`` of every conversation: where it ends and where others leave it.

    A step of the path is the first turn after a node that has more than one continuation; ending is one of them.
    """
    last = steps.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b", "before", "words")).alias("end"))
    zero = F.lit(0).cast("long")
    ends = ids.join(last, "conv_id", "left").select(
        "conv_id",
        F.coalesce("end.depth", zero).alias("depth"),
        F.coalesce("end.a", zero).alias("a"),
        F.coalesce("end.b", zero).alias("b"),
        F.coalesce(F.col("end.before") + F.col("end.words"), zero).alias("words"),
        F.coalesce("end.words", zero).alias("last"),
    )
    ends = stage(ends, "ends")
    going = steps.select("conv_id", "depth", "a", "b", "pa", "pb", "before", "last")
    ending = ends.select(
        "conv_id",
        (F.col("depth") + 1).alias("depth"),
        zero.alias("a"),
        zero.alias("b"),
        F.col("a").alias("pa"),
        F.col("b").alias("pb"),
        F.col("words").alias("before"),
        "last",
    )
    edges = going.unionByName(ending)
    ways = edges.groupBy("depth", "pa", "pb").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in "ab"))
    branching = ways.where("min_a <> max_a OR min_b <> max_b").select("depth", "pa", "pb")
    kept = edges.join(branching, ["depth", "pa", "pb"], "left_semi")
    step = F.struct("depth", "a", "b", "pa", "pb", "before", "last")
    path = kept.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("path"))
    return ends.join(path, "conv_id", "left")


# A component is a list: where its top node is (DEPTH, A, B), the words down to it and in it, and what hangs below.
DEPTH, A, B, TOTAL, LAST, N, CONV, LEAVES, CHILDREN, SAVED = range(10)


def component(row: dict) -> list:
    return [row["depth"], row["a"], row["b"], row["words"], row["last"], 1, row["conv_id"], 0, 0, 0]


def shared(left: dict, right: dict) -> tuple:
    """Depth that two neighbours share, with the hash, all words and the last turn's words there."""
    for x, y in zip(left["path"] or (), right["path"] or ()):
        if x["depth"] != y["depth"] or x["a"] != y["a"] or x["b"] != y["b"]:
            return (x["depth"] - 1, x["pa"], x["pb"], x["before"], x["last"])
    return (left["depth"], left["a"], left["b"], left["words"], left["last"])


def finished(c: list, above: tuple) -> tuple:
    """The final node on top of a component that hangs below ``above``."""
    saved = c[SAVED] + (c[N] - 1) * c[LAST]
    leaves = c[LEAVES] if c[CHILDREN] else 1
    before = c[TOTAL] - c[LAST]
    return (c[CONV], c[DEPTH], c[A], c[B], above[0], above[1], above[2], c[N], c[CHILDREN], leaves, saved, before)


def lifted(c: list, above: tuple) -> list:
    """The component at the node ``above`` whose only child so far is ``c``."""
    saved = c[SAVED] + (c[N] - 1) * (c[TOTAL] - above[3])
    return [*above, c[N], c[CONV], c[LEAVES] if c[CHILDREN] else 1, 1, saved]


def contract(components: list, edges: list, open_left: bool, open_right: bool, nodes: list) -> tuple[list, list]:
    """Unite neighbours in descending depth; final nodes go to ``nodes``, the rest of the forest is returned."""
    n = len(components)
    parent, tree = list(range(n)), list(components)
    open_ = [False] * n
    open_[0], open_[-1] = open_[0] or open_left, open_[-1] or open_right

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left_over = []
    for i in sorted(range(n - 1), key=lambda i: (-edges[i][0], i)):
        edge, sides = edges[i], (find(i), find(i + 1))
        for x in sides:
            if tree[x][DEPTH] > edge[0] and not open_[x]:
                nodes.append(finished(tree[x], edge))
                tree[x] = lifted(tree[x], edge)
        x, y = sides
        if tree[x][DEPTH] == tree[y][DEPTH] == edge[0]:
            one, two = tree[x], tree[y]
            parent[y] = x
            open_[x] = open_[x] or open_[y]
            tree[x] = [
                *one[:N], one[N] + two[N], min(one[CONV], two[CONV]), *(one[k] + two[k] for k in (LEAVES, CHILDREN, SAVED))
            ]
        else:
            left_over.append(i)
            open_[x] = open_[y] = True
    kept = sorted(left_over)
    roots = [find(i) for i in kept] + [find(n - 1)]
    return [tree[r] for r in roots], [edges[i] for i in kept]


def whole_forest(components: list, edges: list, nodes: list) -> None:
    """End of the merge: nothing is open, and the root is what all hang below."""
    components, _ = contract(components, edges, False, False, nodes)
    root = (0, 0, 0, 0, 0)
    top = components[0]
    if top[DEPTH] > 0:
        nodes.append(finished(top, root))
        top = lifted(top, root)
    nodes.append(finished(top, (-1, 0, 0, 0, 0)))


def _batch(nodes: list, pid: int, forest: tuple | None) -> pa.RecordBatch:
    rows = len(nodes) + (forest is not None)
    columns = list(zip(*nodes)) if nodes else [()] * len(NODE_NAMES)
    pad = [None] * (rows - len(nodes))
    out = {name: pa.array([*column, *pad], pa.int64()) for name, column in zip(NODE_NAMES, columns)}
    blobs = [None] * len(nodes) + ([pickle.dumps(forest)] if forest is not None else [])
    return pa.RecordBatch.from_pydict(out | {"pid": pa.array([pid] * rows, pa.int32()), "forest": pa.array(blobs, pa.binary())})


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Final nodes of a partition of sorted paths, and its contracted forest with the paths at both ends."""
    pid = TaskContext.get().partitionId()
    components, edges, first, before = [], [], None, None
    for batch in batches:
        for row in batch.to_pylist():
            if before is not None:
                edges.append(shared(before, row))
            first = first or row
            before = row
            components.append(component(row))
        if components:
            nodes = []
            components, edges = contract(components, edges, True, True, nodes)
            yield _batch(nodes, pid, None)
    if first:
        yield _batch([], pid, (components, edges, first, before))


def _merge(forests: list[tuple], nodes: list) -> tuple:
    """One contracted forest of neighbouring ones, in order."""
    components, edges, first, before = forests[0]
    components, edges = list(components), list(edges)
    for more, links, start, end in forests[1:]:
        edges += [shared(before, start), *links]
        components += more
        before = end
    components, edges = contract(components, edges, True, True, nodes)
    return components, edges, first, before


def _merger(last: bool):
    """Merge of the forests of ``FAN`` neighbouring partitions."""

    def merge(key, table):
        from labelloom.llm import trie as t

        rows = sorted(zip(table.column("pid").to_pylist(), table.column("forest").to_pylist()))
        nodes = []
        one = t._merge([pickle.loads(blob) for _, blob in rows], nodes)
        if last:
            t.whole_forest(one[0], one[1], nodes)
        return pa.Table.from_batches([t._batch(nodes, key[0].as_py(), None if last else one)])

    return merge


def explicit_nodes(ended: DataFrame) -> DataFrame:
    """Root, branching nodes and ends, from ``paths``; staged."""
    dealt = ended.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    schema = NODE + ", pid int, forest binary"
    ship_package(ended.sparkSession)
    found = stage(dealt.mapInArrow(_grow, schema), "forest")
    levels = [found.where("forest IS NULL").select(*NODE_NAMES)]
    most = found.where("forest IS NOT NULL").agg(F.max("pid")).first()[0]
    while most is not None:
        last = most < FAN

        forests = found.where("forest IS NOT NULL").select(F.floor(F.col("pid") / FAN).cast("int").alias("above"), "pid", "forest")
        found = stage(forests.groupBy("above").applyInArrow(_merger(last), schema), "forest")
        levels.append(found.where("forest IS NULL").select(*NODE_NAMES))
        most = None if last else most // FAN
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    return nodes


def end_digests(ended: DataFrame) -> DataFrame:
    """``(depth, a, b, ends_sha256)``: digest of the sorted ids of the conversations that end at a node."""

    def run(batches):
        key, digest = None, None
        for batch in batches:
            out = []
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "conv_id"))):
                if at != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = at, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            if out:
                yield _digest_batch(out)
        if key:
            yield _digest_batch([(*key, digest.hexdigest())])

    order = ("depth", "a", "b")
    dealt = ended.select(*order, "conv_id").repartition(*order).sortWithinPartitions(*order, "conv_id")
    return dealt.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def _digest_batch(rows: list) -> pa.RecordBatch:
    names, kinds = ("depth", "a", "b", "ends_sha256"), (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})


def trie(steps: DataFrame, ids: DataFrame) -> DataFrame:
    """Every node of the trie of the conversations ``ids`` whose turns are ``steps``, as ``along`` made them."""
    ended = stage(paths(steps, ids), "paths")
    nodes = stage(explicit_nodes(ended), "nodes")
    names = nodes.select(F.col("conv_id").alias("parent"), F.col("depth").alias("top"), F.col("a").alias("pa"), F.col("b").alias("pb"))
    full = nodes.join(names, ["top", "pa", "pb"], "left").join(end_digests(ended), ["depth", "a", "b"], "left")
    full = stage(full.drop("a", "b", "pa", "pb"), "explicit")
    lowest = F.greatest(F.col("top") + 1, F.lit(0))
    blocks = full.withColumn("low", lowest).withColumn("from", F.explode(F.sequence("low", "depth", F.lit(SPAN).cast("long"))))
    at = F.explode(F.sequence("from", F.least(F.col("from") + SPAN - 1, "depth")))
    listed = blocks.select("*", at.alias("at"))
    alone = listed.where("n = 1 OR at = 0").withColumn("so_far", F.col("above"))
    words = steps.select(F.col("conv_id").alias("of"), F.col("depth").alias("place"), F.col("before").alias("so_far"))
    several = listed.where("n > 1 AND at > 0").join(words, (F.col("conv_id") == F.col("of")) & (F.col("at") == F.col("place")))
    out = alone.unionByName(several.drop("of", "place"))
    bottom = F.col("at") == F.col("depth")
    return out.select(
        "conv_id",
        F.col("at").alias("depth"),
        F.when(F.col("at") > 0, F.when(F.col("at") == F.col("low"), F.col("parent")).otherwise(F.col("conv_id"))).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * (F.col("above") - F.col("so_far"))).alias("saved_tokens"),
        F.when(bottom, F.coalesce("ends_sha256", F.lit(NOTHING))).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt ``conversations (conv_id, turn, role, text)``."""
    steps, ids = rebuilt(turns_of(conversations))
    return trie(steps, ids)
