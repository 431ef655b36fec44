"""Prefix trie of conversations: every distinct beginning is a node with subtree figures.

A conversation is a path of turn digests, so a trie node is a run of neighbouring paths in
sorted order.  Paths are dealt to shards by splitters (a path and a conversation, cut
after the first turn that tells it from the sampled path before), so copies of one
conversation spread over shards as well.  A node whose run crosses a splitter is a
beginning of that splitter; these nodes, the skeleton, are broadcast.  Every shard is
sorted and read once with the open nodes on a stack: other nodes are finished there, and
skeleton nodes leave a partial row per shard, which a reduction puts together.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WIDTH = 16                  # bytes of a turn's digest
SIZE = 4                    # bytes of the length of a turn's text
SHARD_TURNS = 400_000       # turns of a shard, about
MAX_SHARDS = 8192
SAMPLES = 16                # sampled paths per shard
HEAD_TURNS = 1024           # turns of a sampled path that reach the driver
PIECE = 1 << 20             # characters of one piece of a list of conversations
SMALL_SKELETON = 1_000_000  # nodes (two numbers each) up to which their table is broadcast

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256"]
ROWS = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, parent_skeleton long, "
        "skeleton long, shard long, size long, piece long, ends string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
               role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, path, sizes``: the digests of a conversation's turns (role and text), one after
    the other, and the code points of their texts (4 bytes each).

    Turns are ordered by ``turn``, nulls first; turns with an equal number in the order of
    their digests.  Null roles and texts are empty; a repeated row is a turn of its own;
    rows without a conversation belong to none and leave.  Texts of any length are digested
    where they are read and never shuffled: a task holds 20 bytes for each turn of a
    conversation, and a conversation's turns are put together in part before the shuffle.
    """
    r = F.coalesce(turns[role].cast("string"), F.lit(""))
    t = F.coalesce(turns[text].cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t)
    at = F.struct(turns[turn].alias("turn"),
                  F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH).alias("digest"),
                  F.char_length(t).alias("size"))
    lists = turns.where(turns[conv_id].isNotNull()).select(
        turns[conv_id].cast("long").alias("conv_id"), at.alias("at")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("at")).alias("at"))
    return lists.select("conv_id", *(
        F.unhex(F.array_join(F.transform("at", make), "")).alias(name) for name, make in (
            ("path", lambda x: F.hex(x["digest"])),
            ("sizes", lambda x: F.lpad(F.hex(x["size"]), 2 * SIZE, "0")))))


def graft(paths: DataFrame, heads: DataFrame, base: Column, keep: Column, most: int) -> DataFrame:
    """Conversations that begin with another's turns: the first ``keep`` (at most ``most``)
    turns of conversation ``base`` from ``heads``, then the own turns after the first ``keep``.

    A base that is not in ``heads`` has no turns.  Only ``most`` turns of a head are joined.
    """
    short = heads.select(F.col("conv_id").alias("base"), *(
        F.substring(c, 1, most * w).alias(f"head_{c}")
        for c, w in (("path", WIDTH), ("sizes", SIZE))))
    rows = paths.select("*", base.alias("base"), keep.cast("int").alias("keep"))
    parts = (f"concat(coalesce(substring(head_{c}, 1, keep * {w}), X''), "
             f"substring({c}, keep * {w} + 1)) AS {c}"
             for c, w in (("path", WIDTH), ("sizes", SIZE)))
    return rows.join(short, "base", "left").selectExpr("conv_id", *parts)


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns which two paths have in common from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    differs = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differs.argmax()) // WIDTH


LOW = -(1 << 63) - 1        # below every conversation's number


def choose_splitters(sample: list[tuple[bytes, int, int]], shards: int) -> list[tuple[bytes, int]]:
    """Where to cut a sorted sample of (path, conversation, turns) into shards of like turns.

    A splitter is the shortest beginning of a sampled path that is greater than the path
    before it, or, among copies, the path and a conversation.  Copies of a path cut short
    at ``HEAD_TURNS`` can't be told apart and stay in one shard.
    """
    sample = sorted(sample)
    weights = np.cumsum([1 + turns for *_, turns in sample])
    out: list[tuple[bytes, int]] = []
    for k in range(1, shards):
        i = int(np.searchsorted(weights, weights[-1] * k / shards)) if sample else 0
        if not 0 < i < len(sample):
            continue
        (a, _, _), (b, conv, turns) = sample[i - 1], sample[i]
        if a != b:
            cut = (b[:(shared_turns(a, b) + 1) * WIDTH], LOW)
        elif turns * WIDTH == len(b):
            cut = (b, conv)
        else:
            continue
        if not out or cut > out[-1]:
            out.append(cut)
    return out


class Skeleton:
    """Trie of the splitters' paths: nodes numbered from the root (0), a parent before its children."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.parent, self.depth = [-1], [0]
        self.kids: list[dict[bytes, int]] = [{}]
        for path, _ in splitters:
            at = 0
            for lo in range(0, len(path), WIDTH):
                turn = path[lo:lo + WIDTH]
                if turn not in self.kids[at]:
                    self.kids[at][turn] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                    self.kids.append({})
                at = self.kids[at][turn]

    def above(self, node: int) -> list[int]:
        """The node and its ancestors."""
        out = [node]
        while self.parent[out[-1]] >= 0:
            out.append(self.parent[out[-1]])
        return out


class _Open:
    """A node whose members are still being read."""

    __slots__ = ("size", "skeleton", "low", "members", "children", "leaves", "saved", "digest",
                 "ends", "held", "pieces", "waiting")

    def __init__(self, size: int, skeleton: int):
        self.size, self.skeleton = size, skeleton
        self.low: int | None = None
        self.members = self.children = self.leaves = self.saved = 0
        self.digest = None
        self.ends: list[str] = []
        self.held = self.pieces = 0
        self.waiting: list[tuple] = []


class ShardReader:
    """Reads a shard's rows in order and collects the rows of ``ROWS`` in ``out``."""

    def __init__(self, kids: list[dict[bytes, int]]):
        self.kids = kids
        self.stack: list[_Open] = []
        self.path = b""
        self.shard = -1
        self.out: list[tuple] = []

    def read(self, shard: int, conv: int, path: bytes, sizes: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.path, self.stack = shard, b"", [_Open(0, 0)]
        common = shared_turns(path, self.path)
        while len(self.stack) - 1 > common:
            self._pop()
        lengths = np.frombuffer(sizes, ">u4").tolist()
        for at in range(common, len(lengths)):
            up = self.stack[-1].skeleton
            inside = self.kids[up].get(path[at * WIDTH:(at + 1) * WIDTH], -1) if up >= 0 else -1
            self.stack.append(_Open(lengths[at], inside))
        self.path = path
        top = self.stack[-1]
        top.members += 1
        top.low = conv if top.low is None else min(top.low, conv)
        if top.skeleton < 0:
            if top.digest is None:
                top.digest = hashlib.sha256(str(conv).encode())
            else:
                top.digest.update(f",{conv}".encode())
        else:
            top.ends.append(str(conv))
            top.held += len(top.ends[-1]) + 1
            if top.held >= PIECE:
                self._flush_ends(top)

    def close(self) -> None:
        while self.stack:
            self._pop()

    def _flush_ends(self, node: _Open) -> None:
        self.out.append((*[None] * 9, node.skeleton, self.shard, None, node.pieces,
                         ",".join(node.ends)))
        node.ends, node.held, node.pieces = [], 0, node.pieces + 1

    def _pop(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        up = self.stack[-1] if self.stack else None
        if node.skeleton >= 0:
            if node.ends:
                self._flush_ends(node)
            self.out.append((node.low, depth, None, node.members, node.children, node.leaves,
                             node.saved, None, None, node.skeleton, self.shard, node.size, None,
                             None))
        else:
            node.leaves = node.leaves or 1
            node.saved += (node.members - 1) * node.size
            row = (depth, node.members, node.children, node.leaves, node.saved,
                   node.digest.hexdigest() if node.digest else NO_ENDS)
            if up.skeleton >= 0:
                self._finish(node.low, row, None, up.skeleton)
            else:
                up.waiting.append((node.low, row))
            for low, below in node.waiting:
                self._finish(low, below, node.low, None)
            up.children += 1
            up.leaves += node.leaves
            up.saved += node.saved
        if up:
            up.members += node.members
            up.low = node.low if up.low is None else min(up.low, node.low)

    def _finish(self, low: int, row: tuple, parent: int | None, skeleton: int | None) -> None:
        self.out.append((low, row[0], parent, *row[1:], skeleton, *[None] * 5))


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each skeleton node's pieces, which come in order, piece by piece."""
    node, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()),
                                           pa.array([digest.hexdigest()])], ["skeleton", "found"])

    for batch in batches:
        for at, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if at != node:
                if node is not None:
                    yield row()
                node, digest = at, hashlib.sha256(ends.encode())
            else:
                digest.update(f",{ends}".encode())
    if node is not None:
        yield row()


def trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``paths`` (``conv_id, path, sizes``; ``turn_paths``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's; null at the root),
    ``n_convs`` (members: conversations that begin with the node), ``n_children``, ``n_leaves``
    (childless nodes in the subtree, itself included), ``saved_tokens`` (over the subtree,
    each node's members beyond the first times the code points of its last text) and
    ``ends_sha256`` (of the members that end there, ascending and comma-joined).

    Conversations without turns are members of the root; no conversations give no rows.
    Shards hold about ``SHARD_TURNS`` turns and are at least as many as the session's shuffle
    partitions.  A task holds one shard's open nodes and the rows that wait for their
    parent, never a skeleton node's members.  The driver holds ``SAMPLES`` beginnings of paths
    per shard and the skeleton: at most ``MAX_SHARDS`` times the turns that neighbours share.
    The list of the conversations that end at one node is hashed from front to back, in
    pieces, since its digest can't be taken in parts.
    """
    spark = paths.sparkSession
    turns = F.length("path") / WIDTH
    n, total = paths.agg(F.count("*"), F.sum(turns)).first()
    if shards is None:
        wanted = -(-(n + int(total or 0)) // SHARD_TURNS)
        shards = min(MAX_SHARDS, max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    share = min(1.0, SAMPLES * shards / max(n, 1))
    sample = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    splitters = choose_splitters([(bytes(r[0]), r[1], int(r[2])) for r in sample.select(
        F.substring("path", 1, HEAD_TURNS * WIDTH), "conv_id", turns).collect()], shards)
    skeleton = Skeleton(splitters)
    cuts, kids = (spark.sparkContext.broadcast(x) for x in (splitters, skeleton.kids))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(),
                       strict=True)
            at = [bisect_right(cuts.value, key) for key in keys]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns],
                                             ["shard", *batch.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader(kids.value)
        schema = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind
                            in (c.split() for c in ROWS.split(", "))])

        def flush() -> pa.RecordBatch:
            columns = zip(*reader.out, strict=True)
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            reader.out = []
            return made

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader.read(*row)
                if len(reader.out) >= 20_000:
                    yield flush()
        reader.close()
        if reader.out:
            yield flush()

    dealt = paths.select("conv_id", "path", "sizes").mapInArrow(
        deal, "shard int, conv_id long, path binary, sizes binary")
    rows = written(dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "path", "conv_id").mapInArrow(run, ROWS), "trie-rows")
    return _reduced(rows, skeleton)


def _reduced(rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes of ``rows`` with the skeleton's, whose partial rows are added up."""
    spark = rows.sparkSession
    shape = spark.createDataFrame(
        [(k, skeleton.parent[k], len(skeleton.kids[k]), skeleton.above(k))
         for k in range(len(skeleton.parent))],
        "skeleton long, parent long, kids long, above array<long>")
    totals = rows.where("skeleton IS NOT NULL AND ends IS NULL").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("size").alias("size"), *(F.sum(c).alias(c) for c in (
            "n_convs", "n_children", "n_leaves", "saved_tokens")))
    nodes = totals.join(shape, "skeleton").withColumn("n_children", F.expr("n_children + kids"))
    sums = nodes.select(
        F.explode("above").alias("skeleton"),
        F.expr("n_leaves + if(n_children = 0, 1, 0)").alias("n_leaves"),
        F.expr("saved_tokens + (n_convs - 1) * size").alias("saved_tokens")).groupBy(
        "skeleton").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens")
                        .alias("saved_tokens"))
    ends = rows.where("ends IS NOT NULL").repartition("skeleton").sortWithinPartitions(
        "skeleton", "shard", "piece").select("skeleton", "ends").mapInArrow(
        _hash_pieces, "skeleton long, found string")
    low = totals.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    if len(skeleton.parent) <= SMALL_SKELETON:
        low = F.broadcast(low)
    tops = nodes.drop("n_leaves", "saved_tokens").join(sums, "skeleton").join(
        ends, "skeleton", "left").join(low, "parent", "left").withColumn(
        "ends_sha256", F.coalesce("found", F.lit(NO_ENDS)))
    done = rows.where("skeleton IS NULL").withColumnRenamed("parent_conv_id", "known").join(
        low, F.col("parent_skeleton") == F.col("parent"), "left").withColumn(
        "parent_conv_id", F.coalesce("known", "parent_conv_id"))
    return done.select(NODE).unionByName(tops.select(NODE))
