"""Operator 12: prefix trie of conversations, from ternary search trees.

A turn is a cell of 20 bytes: 16 of the SHA-256 of its role and text, then the
text's number of code points.  A conversation is the binary concatenation of
its cells (its path), so binary order is the order of cell sequences and a
prefix of turns is a prefix of bytes.

1. Paths are sorted over range shards of (path, conv_id).  Equal paths lie
   together, and a very frequent one is split over shards like any other.
2. A shard encodes its cells by a dictionary of its own (dense ids in cell
   order) and inserts the distinct paths into a ternary search tree, median
   first, so the siblings of every node form balanced search trees.  Parents
   are made before their children: one pass back over the nodes adds up
   members, leaves and savings without recursion.
3. Only prefixes of a shard's first and last path can also occur in another
   shard.  These boundary nodes are merged by key.  What lies below them inside
   shards is additive; what boundary nodes themselves add (a leaf, savings) is
   counted in the first chain that holds the node and summed upwards along
   that chain.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricefold.llm.shared import scratch, stage, tidy

CELL = 20
#: Bytes of cells of a shard: one task's tree.
SHARD_BYTES = 4 << 20
#: Ids of a boundary path's members travel in chunks of this many.
IDS = 10_000
SALTS = 16
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_cells(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """``conv_id`` (long), ``turn`` and ``cell`` per row with an integer conversation id."""
    r, x = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, x), 256), 1, 32)
    cell = F.unhex(F.concat(digest, F.lpad(F.hex(F.length(x)), 8, "0")))
    return (conversations.select(F.col(conv).try_cast("long").alias("conv_id"), F.col(turn).alias("turn"), cell.alias("cell"))
            .where(F.col("conv_id").isNotNull()))


def rebuilt_paths(cells: DataFrame, share: int = 100, most: int = 6) -> DataFrame:
    """``path`` and ``conv_id`` of every conversation c after its first h turns
    were replaced by those of conversation ``c - c % share`` (all if fewer, none
    if it is absent); h = unsigned crc32 of the decimal id, modulo ``most``.

    One shuffle by that leading conversation's id; rows are sorted, and a task
    holds one conversation at a time beside the leader's first turns.
    """
    lead = F.col("conv_id") - F.col("conv_id") % share
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = (cells.withColumn("lead", lead).withColumn("h", h).repartition("lead")
            .sortWithinPartitions("lead", F.col("conv_id") != F.col("lead"), "conv_id", F.col("turn").asc_nulls_first(), "cell")
            .select("lead", "conv_id", "h", "cell"))

    @tidy
    def run(batches):
        leader, start, open_ = None, b"", None  # open_: (lead, conv, h, parts) still growing

        def close():
            nonlocal leader, start
            lead, c, h, parts = open_
            own = b"".join(parts)
            if lead != leader:
                leader, start = lead, b""
            if c == lead:
                start = own[: CELL * most]
            return start[: CELL * h] + own[CELL * h :], c

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            cells_ = batch.column("cell").cast(pa.large_binary())
            at = np.frombuffer(cells_.buffers()[1], np.int64)[cells_.offset]
            data = memoryview(cells_.buffers()[2])[at : at + CELL * n]
            leads, hs = batch.column("lead").to_pylist(), batch.column("h").to_pylist()
            cut = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), n]
            out = []
            for a, b in zip(cut, cut[1:]):
                part = bytes(data[CELL * a : CELL * b])
                if open_ is not None and open_[1] == ids[a]:
                    open_[3].append(part)
                    continue
                if open_ is not None:
                    out.append(close())
                open_ = (leads[a], int(ids[a]), hs[a], [part])
            yield _paths(out)
        if open_ is not None:
            yield _paths([close()])

    return rows.mapInArrow(run, "path binary, conv_id long")


def _paths(rows: list[tuple[bytes, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.int64())],
                                      ["path", "conv_id"])


class Tree:
    """Ternary search tree: ``less`` and ``more`` lead to smaller and larger
    siblings, ``below`` to the first child.  Node 0 is the root."""

    def __init__(self):
        self.symbol, self.less, self.more, self.below, self.parent, self.depth = [-1], [-1], [-1], [-1], [-1], [0]

    def _new(self, symbol: int, parent: int) -> int:
        for column, value in ((self.symbol, symbol), (self.less, -1), (self.more, -1), (self.below, -1),
                              (self.parent, parent), (self.depth, self.depth[parent] + 1)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, symbols: list[int]) -> int:
        """The node at the end of ``symbols``, made where it is missing."""
        node, symbol, less, more, below = 0, self.symbol, self.less, self.more, self.below
        for s in symbols:
            at = below[node]
            if at < 0:
                at = below[node] = self._new(s, node)
            while (t := symbol[at]) != s:
                side = less if s < t else more
                if side[at] < 0:
                    side[at] = self._new(s, node)
                at = side[at]
            node = at
        return node

    def chain(self, node: int) -> list[int]:
        """Nodes from the root to ``node``."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]


def medians(n: int):
    """0 to n - 1, the middle of every stretch before its halves."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            todo += [(m + 1, b), (a, m)]


#: inner: a whole node; edge: one shard's part of a boundary node; ids: members that end at a boundary node.
NODE = ("kind string, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, ends string, chars long, shard int, chain int, ids string")
_NAMES = [c.split()[0] for c in NODE.split(", ")]
_TYPES = {"binary": pa.binary(), "string": pa.string(), "long": pa.int64(), "int": pa.int32()}
_KINDS = [_TYPES[c.split()[1]] for c in NODE.split(", ")]


def _rows(rows: list[tuple]):
    for a in range(0, len(rows), 20_000):
        cols = zip(*rows[a : a + 20_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _KINDS)], _NAMES)


def _runs(batches):
    """Distinct paths of sorted rows, each with its members' ids."""
    path, ids = None, []
    for batch in batches:
        for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()):
            if p != path:
                if path is not None:
                    yield path, ids
                path, ids = p, []
            ids.append(c)
    if path is not None:
        yield path, ids


def _decimal(ids: list[int]) -> str:
    return ",".join(map(str, ids))


@tidy
def _shard(batches):
    shard = TaskContext.get().partitionId()
    paths, sizes, least, ends, outer = [], [], [], [], {}
    last = None
    for path, ids in _runs(batches):
        if not paths:
            outer[0] = ids
        paths.append(path)
        sizes.append(len(ids))
        least.append(ids[0])
        ends.append(hashlib.sha256(_decimal(ids).encode()).hexdigest())
        last = ids
    if not paths:
        return
    outer[len(paths) - 1] = last

    words, codes = np.unique(np.frombuffer(b"".join(paths), f"V{CELL}"), return_inverse=True)
    chars = [int.from_bytes(w.tobytes()[-4:], "big") for w in words]
    cut = np.cumsum([0, *(len(p) // CELL for p in paths)]).tolist()
    codes = codes.tolist()
    tree = Tree()
    at = [0] * len(paths)
    for i in medians(len(paths)):
        at[i] = tree.insert(codes[cut[i] : cut[i + 1]])

    n = len(tree.symbol)
    chains = [tree.chain(at[0]), tree.chain(at[-1])]
    edge = set(chains[0]) | set(chains[1])
    members, first, end = [0] * n, [None] * n, [_EMPTY] * n
    for i, node in enumerate(at):
        members[node], first[node], end[node] = sizes[i], least[i], ends[i]
    kids, leaves, saved = [0] * n, [0] * n, [0] * n
    parent = tree.parent
    for v in range(n - 1, 0, -1):  # children come after their parents
        p = parent[v]
        if v not in edge:
            saved[v] += (members[v] - 1) * chars[tree.symbol[v]]
            if not kids[v]:
                leaves[v] = 1
            kids[p] += 1
        members[p] += members[v]
        leaves[p] += leaves[v]
        saved[p] += saved[v]
        if first[p] is None or first[v] < first[p]:
            first[p] = first[v]

    keys = {}
    for chain, i in zip(chains, (0, len(paths) - 1)):
        so_far = hashlib.sha256()
        keys[0] = so_far.digest()[:16]
        for d, v in enumerate(chain[1:]):
            so_far.update(paths[i][d * CELL : (d + 1) * CELL])
            keys[v] = so_far.digest()[:16]
    straddles = {at[i] for i in outer}
    out = []
    for v in range(1, n):
        if v not in edge:
            p = parent[v]
            out.append(("inner", None, keys.get(p), first[v], tree.depth[v], None if p in edge else first[p], members[v],
                        kids[v], leaves[v], saved[v], end[v], None, None, None, None))
    told = set()
    for c, chain in enumerate(chains):
        for v in chain:
            once = v not in told  # a node of both chains tells its part once
            told.add(v)
            p = parent[v]
            whole = end[v] if v not in straddles and end[v] != _EMPTY else None
            out.append(("edge", keys[v], keys[p] if v else None, first[v], tree.depth[v], None, members[v] if once else 0,
                        kids[v] if once else 0, leaves[v] if once else 0, saved[v] if once else 0, whole,
                        chars[tree.symbol[v]] if v else 0, shard, c, None))
    for i, ids in outer.items():
        for k in range(0, len(ids), IDS):
            out.append(("ids", keys[at[i]], None, k, None, None, None, None, None, None, None, None, shard, None,
                        _decimal(ids[k : k + IDS])))
    yield from _rows(out)


@tidy
def _hash_ends(batches):
    """Chunks of ids in order per key -> the hash of all of them."""
    key, run = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    out.append((key, run.hexdigest()))
                key, run = k, hashlib.sha256(ids.encode())
            else:
                run.update(b"," + ids.encode())
        yield _ends(out)
    if key is not None:
        yield _ends([(key, run.hexdigest())])


def _ends(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([h for _, h in rows], pa.string())],
                                      ["key", "all_ends"])


def _merged(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, one row per key."""
    per = edges.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inside"), F.sum("n_leaves").alias("leaves_in"),
        F.sum("saved_tokens").alias("saved_in"), F.max("chars").alias("chars"), F.max("ends").alias("ends"),
        F.min(F.struct("shard", "chain")).alias("home"))
    kids = per.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("also"))
    hashed = ids.repartition("key").sortWithinPartitions("key", "shard", "conv_id").select("key", "ids") \
        .mapInArrow(_hash_ends, "key binary, all_ends string")
    per = per.join(kids, "key", "left").join(hashed, "key", "left").select(
        "*", (F.col("inside") + F.coalesce("also", F.lit(0))).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"))
    own = per.select("key", "home", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"), "own_saved")
    here = F.struct("shard", "chain") == F.col("home")
    below = Window.partitionBy("shard", "chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    up = edges.select("key", "shard", "chain", "depth").join(own, "key").select(
        "key", F.sum(F.when(here, F.col("leaf")).otherwise(0)).over(below).alias("leaf"),
        F.sum(F.when(here, F.col("own_saved")).otherwise(0)).over(below).alias("own")) \
        .groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    return per.join(up, "key").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", "n_children", (F.col("leaves_in") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved_in") + F.col("own")).alias("saved_tokens"), F.coalesce("ends", "all_ends", F.lit(_EMPTY)).alias("ends_sha256"))


def prefix_nodes(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``paths`` (``path``, ``conv_id``): the
    smallest member as ``conv_id``, ``depth``, ``parent_conv_id`` (root: null),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes at or below it),
    ``saved_tokens`` (at or below it: members but one, times code points of the
    last text) and ``ends_sha256`` (SHA-256 of the ids that end there, ascending).

    The root's path is empty.  A path is one row: 20 bytes a turn.  No paths: no rows.
    """
    spark = paths.sparkSession
    folder = scratch(spark, "trie")
    shards = shards or spark.sparkContext.defaultParallelism
    dealt = paths.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = stage(dealt.mapInArrow(_shard, NODE), folder, "nodes")
    edges, ids = nodes.where("kind = 'edge'"), nodes.where("kind = 'ids'")
    merged = stage(_merged(edges, ids), folder, "merged")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = nodes.where("kind = 'inner'").withColumnRenamed("ends", "ends_sha256")
    rest = inner.select("parent_key", *columns).unionByName(merged.select(
        "parent_key", *(F.lit(None).cast("long").alias(c) if c == "parent_conv_id" else c for c in columns)))
    # children of boundary nodes; the root's may be most of all nodes, so parents are dealt in salted copies
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"),
                            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    asks = rest.where(F.col("parent_key").isNotNull()).withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    answered = asks.join(parents, ["parent_key", "salt"]).withColumn("parent_conv_id", F.col("found"))
    return rest.where(F.col("parent_key").isNull()).select(*columns).unionByName(answered.select(*columns))


def conversation_trie(conversations: DataFrame, share: int = 100, most: int = 6) -> DataFrame:
    """``prefix_nodes`` of the conversations rebuilt by ``rebuilt_paths``.

    Rows without an integer ``conv_id`` belong to no conversation and are left
    out.  Turns are ordered by ``turn``, nulls first, equal ones by their cell;
    a null role or text is an empty one.  Repeated rows are turns of their own.
    A conversation of 400 or 400,000 turns is one row of 20 bytes a turn,
    whatever the length of its texts.  Empty table: no rows.  Other columns,
    whatever their names, are ignored.
    """
    scratch(conversations.sparkSession, "turns")
    turns = conversations.count()
    shards = max(conversations.sparkSession.sparkContext.defaultParallelism, -(-turns * CELL // SHARD_BYTES))
    return prefix_nodes(rebuilt_paths(turn_cells(conversations), share, most), shards)
