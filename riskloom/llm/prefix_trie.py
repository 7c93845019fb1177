"""A prefix trie over conversations by vertical bitmaps.

The trie is never built as a tree of rows: conversations are cut into shards, a shard indexes
each (position, turn) to the bitset of its conversations that have this turn there, and goes
down depth first. A child of a node is the intersection of the node's bitset with a posting;
its popcount is the number of members, its lowest bit the smallest one, and its intersection
with the conversations of that length the list of those that end in it. Shards are runs of
conversations in the order of their ids, so a first turn that a third of all share costs one row
per shard, and their nodes are summed by the key of their path.

The key of a path is the exclusive or of two 64-bit hashes of each (position, turn) on it; that
different paths share both is left out of account. A conversation of more than `span` turns is
cut into blocks: a block starts from the key of all blocks before it, so no task needs a whole one.

A node belongs to its smallest member, and the nodes of a conversation are one stretch of its
path down to its end. What a subtree sums up is therefore sent along the path of each owner:
one row per turn, summed by path key, however deep the trie is.

Defined cases: null role and text are empty. Turns with the same number follow by role, then
text; repeated rows are turns of their own. Rows without a conv_id belong to no conversation and
are left out. Conversations without turns end in the root. An empty table has no node. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty
from riskloom.session import materialize

SPAN = 512
SHARD_UNITS = 4096
SHARD_TURNS = 1 << 16
ENDS = 512
NODE = ["depth", "x1", "x2"]


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), t1, t2 (hashes of the turn), chars, as a written table.

    Turns are sorted by range, so that a very long conversation lies in many tasks. Each counts
    its own rows, and the counts of the tasks before are added, a row per task and conversation.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        text_or_empty("role").alias("role"),
        text_or_empty("text").alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = turns.select(
        "conv_id",
        F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(1), "text", "role").alias("t2"),
        F.length("text").cast("long").alias("chars"),
    )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            at = np.arange(len(ids)) - np.repeat(starts, sizes) + 1
            if ids[0] == last:
                at[: sizes[0]] += seen
            last, seen = ids[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at, pa.int64()), pa.array(np.full(len(ids), part), pa.int32())],
                names=["conv_id", "t1", "t2", "chars", "at", "part"],
            )

    schema = "conv_id long, t1 long, t2 long, chars long, at long, part int"
    placed = materialize(turns.mapInArrow(numbered, schema), "trie-turns")
    counts = placed.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = counts.withColumn("carry", F.sum("n").over(before)).where("carry IS NOT NULL")
    # A conversation that goes on in a task: one row per task at most.
    carried = F.broadcast(carried.select("conv_id", "part", "carry"))
    return placed.join(carried, ["conv_id", "part"], "left").select(
        "conv_id",
        (F.col("at") + F.coalesce("carry", F.lit(0))).alias("position"),
        "t1",
        "t2",
        "chars",
    )


def stitched(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: the first h turns of conversation c - c % every, then c's own turns
    after its first h, with h = crc32(c) % most.

    Returns (conv_id, depth, t1, t2, chars) and (conv_id, turns), a row for each conversation.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("position").alias("size"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    own = sizes.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    bases = sizes.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.col("size").alias("base_size")
    )
    own = materialize(
        own.join(bases, "base", "left").select(
            "conv_id",
            "base",
            "h",
            F.least("h", F.coalesce("base_size", F.lit(0))).alias("borrowed"),
            F.greatest(F.col("size") - F.col("h"), F.lit(0)).alias("rest"),
        ),
        "trie-conversations",
    )
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("position") < most))
    heads = heads.withColumnRenamed("conv_id", "base")
    first = own.join(heads, "base").where(F.col("position") <= F.col("h"))
    after = turns.join(own, "conv_id").where(F.col("position") > F.col("h"))
    kept = ["conv_id", "depth", "t1", "t2", "chars"]
    rebuilt = first.withColumn("depth", F.col("position")).select(*kept)
    rebuilt = rebuilt.union(
        after.withColumn("depth", F.col("position") - F.col("h") + F.col("borrowed")).select(*kept)
    )
    return rebuilt, own.select("conv_id", (F.col("borrowed") + F.col("rest")).alias("turns"))


def _units(turns: DataFrame, lengths: DataFrame, span: int) -> DataFrame:
    """block, conv_id, depth, x1, x2, value: a unit is the part of a conversation in a block; its
    first row has the key of the path before it and the length of the conversation."""
    block = F.floor((F.col("depth") - 1) / span).cast("long")
    rows = turns.select(
        block.alias("block"),
        "conv_id",
        "depth",
        F.xxhash64("depth", "t1").alias("x1"),
        F.xxhash64("depth", "t2").alias("x2"),
        F.col("chars").alias("value"),
    )
    rows = materialize(rows, "trie-rebuilt")
    digests = (
        rows.join(lengths.where(F.col("turns") > span), "conv_id")
        .groupBy("conv_id", "block")
        .agg(
            F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.max("turns").alias("turns")
        )
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    later = digests.select(
        "block",
        "conv_id",
        (F.col("block") * span).alias("depth"),
        F.bit_xor("x1").over(before).alias("x1"),
        F.bit_xor("x2").over(before).alias("x2"),
        F.col("turns").alias("value"),
    ).where("block > 0")
    zero = F.lit(0).cast("long")
    first = lengths.select(
        zero.alias("block"),
        "conv_id",
        zero.alias("depth"),
        zero.alias("x1"),
        zero.alias("x2"),
        F.col("turns").alias("value"),
    )
    return rows.unionByName(later).unionByName(first)


class Shard:
    """The units of one block and a run of conversations, in the order of their ids."""

    def __init__(self, span: int, rows: np.ndarray):
        ids, self.depth, value = rows[:, 1], rows[:, 2], rows[:, 5]
        self.span, self.base = span, int(rows[0, 0]) * span
        self.x, self.value = rows[:, 3:5].tolist(), value.tolist()
        heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        self.heads = heads.tolist()
        self.ends = np.r_[heads[1:], len(ids)].tolist()
        self.ids = ids[heads].tolist()
        self.lengths = [self.value[h] for h in self.heads]
        self.postings: dict[tuple, int] = {}
        self.ending: dict[int, int] = {}
        self.roots: dict[tuple, int] = {}
        for unit, (head, end) in enumerate(zip(self.heads, self.ends)):
            bit = 1 << unit
            self.roots[tuple(self.x[head])] = self.roots.get(tuple(self.x[head]), 0) | bit
            if self.lengths[unit] <= self.base + span:
                self.ending[self.lengths[unit]] = self.ending.get(self.lengths[unit], 0) | bit
            for turn in map(tuple, self.x[head + 1 : end]):
                self.postings[turn] = self.postings.get(turn, 0) | bit

    def members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return out

    def nodes(self) -> Iterator[tuple]:
        """(depth, x1, x2, parent x1, x2, members, smallest, chars, ids that end in it)."""
        start = self.base
        stack = [(start, a, b, 0, 0, bits) for (a, b), bits in self.roots.items()]
        while stack:
            depth, a, b, pa_, pb, bits = stack.pop()
            unit = (bits & -bits).bit_length() - 1
            own = bits & self.ending.get(depth, 0)
            if depth > start or not start:
                row = self.heads[unit] + depth - start
                chars = self.value[row] if depth else 0
                yield (depth, a, b, pa_, pb, bits.bit_count(), self.ids[unit], chars, self.members(own))
            rest = bits & ~own
            if depth == start + self.span:
                continue
            while rest:
                unit = (rest & -rest).bit_length() - 1
                c, d = self.x[self.heads[unit] + depth + 1 - start]
                child = bits & self.postings[c, d]
                stack.append((depth + 1, a ^ c, b ^ d, a, b, child))
                rest &= ~child

    def paths(self) -> tuple[np.ndarray, ...]:
        """conv_id, depth, x1, x2 of each step of each unit, the root left out of later blocks."""
        keys = np.array(self.x, np.int64).reshape(-1, 2)
        for head, end in zip(self.heads, self.ends):
            keys[head:end] = np.bitwise_xor.accumulate(keys[head:end], axis=0)
        ids = np.repeat(self.ids, np.diff([*self.heads, len(keys)]))
        kept = np.ones(len(keys), bool)
        if self.base:
            kept[self.heads] = False
        return ids[kept], self.depth[kept], keys[kept, 0], keys[kept, 1]


LOCAL = (
    "depth long, x1 long, x2 long, p1 long, p2 long, n long, conv_id long, chars long, ends string"
)


def _shards(
    batches: Iterator[pa.RecordBatch], span: int, units: int, turns: int
) -> Iterator[Shard]:
    """Shards of so many units or rows, of rows sorted by block, conv_id and depth."""
    held: list[np.ndarray] = []

    def whole(cut: int | None) -> Shard:
        rows = np.concatenate(held)
        mine, held[:] = rows[:cut], [rows[cut:]] if cut else []
        return Shard(span, mine)

    for batch in batches:
        rows = np.column_stack([c.to_numpy() for c in batch.columns])
        if not len(rows):
            continue
        held.append(rows)
        while True:
            rows = held[0] if len(held) == 1 else np.concatenate(held)
            held[:] = [rows]
            new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
            starts = np.flatnonzero(new)
            blocks = np.flatnonzero(rows[starts, 0] != rows[0, 0])
            cut = blocks[0] if len(blocks) else None
            if len(starts) > units and (cut is None or cut > units):
                cut = units
            if len(rows) > turns:
                # Never within a unit; the last one may go on in the next batch.
                most = max(1, int(np.searchsorted(starts, turns, "right")) - 1)
                if most < len(starts) and (cut is None or cut > most):
                    cut = most
            if cut is None:
                break
            yield whole(int(starts[cut]))
    if held and len(held[0]):
        yield whole(None)


def _local(
    turns: DataFrame, lengths: DataFrame, span: int, units: int, size: int
) -> DataFrame:
    """The nodes of each shard (n > 0), the steps of its paths (n = 0) and, in pieces, the ids
    that end in a node (ends, conv_id the first of them)."""
    names = [part.split()[0] for part in LOCAL.split(", ")]
    types = [pa.int64()] * 8 + [pa.string()]

    def batch_of(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, span, units, size):
            rows = []
            for *node, ids in shard.nodes():
                rows.append((*node, None))
                for at in range(0, len(ids), ENDS):
                    part = ids[at : at + ENDS]
                    ends = ",".join(map(str, part))
                    rows.append((*node[:3], None, None, None, part[0], None, ends))
                if len(rows) > 20_000:
                    yield batch_of(list(zip(*rows)))
                    rows = []
            if rows:
                yield batch_of(list(zip(*rows)))
            ids, depth, x1, x2 = shard.paths()
            none = [None] * len(ids)
            zeros = np.zeros(len(ids), np.int64)
            yield batch_of([depth, x1, x2, none, none, zeros, ids, none, none])

    order = ["block", "conv_id", "depth"]
    spread = _units(turns, lengths, span).repartitionByRange("block", "conv_id")
    return spread.sortWithinPartitions(*order).select(
        *order, "x1", "x2", "value"
    ).mapInArrow(run, LOCAL)


def _digests(ends: DataFrame) -> DataFrame:
    """depth, x1, x2, ends_sha256 of the pieces of each node's list, in the order of their ids.

    A digest of a list goes through it from end to end, so a node's pieces meet in one task; it
    holds the state of the digest and a batch of pieces, never the list.
    """
    names = [*NODE, "ends_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            done = []
            for *node, ends in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)]):
                if node != last:
                    if last:
                        done.append((*last, state.hexdigest()))
                    last, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in done], _DIGESTS)
        if last:
            row = dict(zip(names, (*last, state.hexdigest())))
            yield pa.RecordBatch.from_pylist([row], _DIGESTS)

    pieces = ends.select(*NODE, "conv_id", "ends").repartition(*NODE)
    return pieces.sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        run, "depth long, x1 long, x2 long, ends_sha256 string"
    )


_DIGESTS = pa.schema([*((n, pa.int64()) for n in NODE), ("ends_sha256", pa.string())])


def _totals(paths: DataFrame, nodes: DataFrame, span: int) -> DataFrame:
    """depth, x1, x2, n_leaves, saved_tokens: sums over the subtree of each node."""
    block = F.floor((F.col("depth") - 1) / span).cast("long")
    owned = nodes.select(
        "conv_id",
        "depth",
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
    )
    rows = paths.join(owned, ["conv_id", "depth"], "left").withColumn("block", block)
    rows = materialize(rows, "trie-paths")
    sums = rows.groupBy("conv_id", "block").agg(
        F.sum(F.coalesce("saved", F.lit(0))).alias("saved"),
        F.max("leaf").alias("leaf"),
    )
    mine = Window.partitionBy("conv_id")
    after = mine.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("saved").over(after), F.lit(0)).alias("later"),
        F.max("leaf").over(mine).alias("ends_leaf"),
    ).where("ends_leaf IS NOT NULL")  # else it owns no node
    down = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    down = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sent = rows.join(sums, ["conv_id", "block"]).select(
        *NODE,
        "ends_leaf",
        (F.sum(F.coalesce("saved", F.lit(0))).over(down) + F.col("later")).alias("saved"),
    )
    return sent.groupBy(*NODE).agg(
        F.sum("ends_leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )


def trie(
    turns: DataFrame,
    lengths: DataFrame,
    shard_units: int = SHARD_UNITS,
    shard_turns: int = SHARD_TURNS,
    span: int = SPAN,
) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, depth (from 1 without gaps), t1, t2 (hashes of the turn), chars. lengths:
    conv_id, turns, a row for every conversation.
    """
    local = materialize(_local(turns, lengths, span, shard_units, shard_turns), "trie-local")
    nodes = materialize(
        local.where("n > 0")
        .groupBy(*NODE)
        .agg(
            F.sum("n").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.min("chars").alias("chars"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
        ),
        "trie-nodes",
    )
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = nodes.join(children, NODE, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )
    nodes = materialize(nodes, "trie-children")
    totals = _totals(local.where("n = 0").select("conv_id", *NODE), nodes, span)
    digests = _digests(local.where("ends IS NOT NULL"))
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("x1").alias("p1"),
        F.col("x2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    own = nodes.join(totals, NODE).join(digests, NODE, "left")
    with_parent = own.join(parents, ["depth", "p1", "p2"], "left")
    return with_parent.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
