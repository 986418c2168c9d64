"""Conversation prefix trie from balanced parentheses.

A conversation is the path of its turns' prefix hashes (128 bits, each hashing the one
before with the turn's role and text).  Equal paths are counted first, then the distinct
paths are range-sorted, so every subtree is a run of rows, and each range partition is
one shard.  A shard writes its trie as a sequence of parentheses: find-close over range
min-max blocks of the excess delimits subtrees, the rank of ``()`` pairs counts leaves,
and cumulative arrays over the nodes in order of opening give members and savings.

Only nodes on a shard's first or last path (its spines) can reach into another shard.
Shards return them as two paths with partial values; the spines of all shards, two paths
each, are merged by the same encoding, in one task bounded by the number of shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import lookup, ship
from tonearm.session import materialize

#: Prefix hash of the textless root.
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Conversation ids written into one row of the list that is hashed.
IDS_PER_CHUNK = 4096
#: Stands for no id, as null does not sort last in numpy.
NO_ID = np.iinfo(np.int64).max


class Parentheses:
    """A forest in preorder as balanced parentheses, with the excess in range min-max blocks."""

    def __init__(self, depth: np.ndarray):
        n = len(depth)
        self.open = 2 * np.arange(n) - depth + (depth[0] if n else 0)
        sign = np.full(2 * n, -1, np.int64)
        sign[self.open] = 1
        self.excess = np.cumsum(sign)
        pair = np.zeros(2 * n, np.int64)  # rank of "()" by the position of its opening
        pair[:-1] = (sign[:-1] > 0) & (sign[1:] < 0)
        self.pairs = pair
        # Level l holds the least and greatest excess of blocks of 2^l positions.
        self.low, self.high = [self.excess], [self.excess]
        while len(self.low[-1]) > 1:
            lo, hi = self.low[-1], self.high[-1]
            if len(lo) % 2:
                lo, hi = np.append(lo, lo[-1]), np.append(hi, hi[-1])
            self.low.append(np.minimum(lo[::2], lo[1::2]))
            self.high.append(np.maximum(hi[::2], hi[1::2]))

    def _holds(self, level: int, block: np.ndarray, value: np.ndarray) -> np.ndarray:
        inside = block < len(self.low[level])
        at = np.where(inside, block, 0)
        return inside & (self.low[level][at] <= value) & (value <= self.high[level][at])

    def find_close(self) -> np.ndarray:
        """The closing position of every opening: the first later one whose excess is one less."""
        value = self.excess[self.open] - 1
        block, level = self.open + 1, np.full(len(self.open), -1)
        for l in range(len(self.low)):  # up: to the first block right of the opening that holds the value
            odd = (level < 0) & ((block & 1 == 1) | (l == len(self.low) - 1))
            hit = np.flatnonzero(odd)
            found = hit[self._holds(l, block[hit], value[hit])]
            level[found] = l
            rest = level < 0
            block = np.where(rest & (block & 1 == 1), block + 1, block)
            block = np.where(rest, block >> 1, block)
        for l in range(len(self.low) - 1, 0, -1):  # down: to the leftmost half that holds it
            at = np.flatnonzero(level == l)
            left = 2 * block[at]
            block[at] = np.where(self._holds(l - 1, left, value[at]), left, left + 1)
            level[at] = l - 1
        return block


class Trie:
    """The trie of sorted, distinct paths, with its nodes in preorder."""

    def __init__(self, paths: pa.Array):
        lens = np.diff(paths.offsets.to_numpy())
        flat = paths.flatten()
        raw = np.frombuffer(b"".join(flat.to_pylist()), np.dtype("V16"))
        self.row = np.repeat(np.arange(len(lens)), lens)
        starts = np.cumsum(lens) - lens
        at = np.arange(len(raw)) - starts[self.row]
        _, first, back = np.unique(raw, return_index=True, return_inverse=True)
        order = np.argsort(first, kind="stable")  # preorder: paths are sorted
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.first = first[order]                 # an element of each node
        self.node = rank[back.ravel()]            # the node of each element
        self.depth = at[self.first]
        self.parent = np.where(self.depth > 0, self.node[np.maximum(self.first - 1, 0)], -1)
        self.end = self.node[starts + lens - 1]   # the node where each path ends
        self.key = raw[self.first]
        shape = Parentheses(self.depth)
        close = shape.find_close()
        self.size = (close - shape.open + 1) // 2
        ranks = np.concatenate([[0], np.cumsum(shape.pairs)])
        self.leaf = shape.pairs[shape.open] == 1
        self._leaves = lambda: ranks[close + 1] - ranks[shape.open]
        self.n = len(self.depth)

    def leaves(self) -> np.ndarray:
        return self._leaves()

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of ``values`` over every subtree, from one cumulative array."""
        total = np.concatenate([[0], np.cumsum(values)])
        at = np.arange(self.n)
        return total[at + self.size] - total[at]

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least of ``values`` in every subtree: range minima of doubling length."""
        out, table, width = np.empty(self.n, values.dtype), values, 1
        at = np.arange(self.n)
        while True:
            now = np.flatnonzero((self.size >= width) & (self.size < 2 * width))
            out[now] = np.minimum(table[now], table[at[now] + self.size[now] - width])
            if width * 2 > self.n:
                return out
            table = np.minimum(table[:-width], table[width:])
            width *= 2

    def spine(self) -> np.ndarray:
        """Whether a node is on the first or last path."""
        on = np.zeros(self.n, bool)
        for row in (0, self.row[-1]):
            on[self.node[self.row == row]] = True
        return on


_FIELDS = [("chars", pa.int64()), ("members", pa.int64()), ("low", pa.int64()), ("leaves", pa.int64()),
           ("saved", pa.int64()), ("children", pa.int64()), ("ends", pa.string())]
_SPINE = pa.struct([("path", pa.list_(pa.binary())), *[(n, pa.list_(t)) for n, t in _FIELDS]])
_NODE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("up", pa.binary()), ("parent_conv_id", pa.int64()),
                   ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                   ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("spine", _SPINE)])
NODES = ("conv_id long, depth long, up binary, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, spine struct<path:array<binary>, chars:array<long>, "
         "members:array<long>, low:array<long>, leaves:array<long>, saved:array<long>, children:array<long>, "
         "ends:array<string>>")
MERGED = ("key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == NO_ID)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's own nodes, and its two spines as paths with partial values."""
    rows = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
    if rows is None:
        return
    rows = rows.combine_chunks()
    one = lambda name: rows.column(name).combine_chunks()
    trie = Trie(one("path"))
    chars = one("chars").flatten().to_numpy()[trie.first]
    count, low = np.zeros(trie.n, np.int64), np.full(trie.n, NO_ID)
    count[trie.end] = one("n").to_numpy()
    low[trie.end] = one("low").fill_null(NO_ID).to_numpy()
    ends = np.full(trie.n, None, object)
    ends[trie.end] = one("ends").to_pylist()
    members, low = trie.sums(count), trie.least(low)
    spine = trie.spine()
    inner = ~spine
    saved = trie.sums(np.where(inner, (members - 1) * chars, 0))
    leaves = np.where(spine, trie.sums((trie.leaf & inner).astype(np.int64)), trie.leaves())
    children = np.bincount(trie.parent[inner & (trie.parent >= 0)], minlength=trie.n)

    own = np.flatnonzero(inner)
    above = trie.parent[own]
    cut = spine[above]  # the parent's id is known once the spines are merged
    keys = trie.key[above]
    up = pa.array([k.tobytes() if c else None for k, c in zip(keys, cut)], pa.binary())
    known = np.where(cut, NO_ID, low[above])
    out = pa.Table.from_arrays(
        [_ids(low[own]), pa.array(trie.depth[own]), up, _ids(known), pa.array(members[own]), pa.array(children[own]),
         pa.array(leaves[own]), pa.array(saved[own]), pa.array([e or NO_ENDS for e in ends[own]], pa.string()),
         pa.nulls(len(own), _SPINE)], schema=_NODE)
    yield from out.to_batches(max_chunksize=10_000)

    told = np.zeros(trie.n, bool)
    for row in dict.fromkeys((0, int(trie.row[-1]))):
        nodes = trie.node[trie.row == row]
        new = ~told[nodes]  # nodes of both paths give their values once
        told[nodes] = True
        values = {"chars": chars[nodes], "members": members[nodes] * new, "low": low[nodes],
                  "leaves": leaves[nodes] * new, "saved": saved[nodes] * new, "children": children[nodes] * new}
        line = {k: v.tolist() for k, v in values.items()} | {
            "path": [k.tobytes() for k in trie.key[nodes]], "ends": ends[nodes].tolist()}
        yield pa.RecordBatch.from_pylist([{"spine": line}], schema=_NODE)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The final nodes of the spines of all shards, from their sorted paths."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    lines = pa.Table.from_batches(batches).combine_chunks()
    one = lambda name: lines.column(name).combine_chunks()
    trie = Trie(one("path"))
    total = {}
    for name in ("members", "leaves", "saved", "children"):
        total[name] = np.zeros(trie.n, np.int64)
        np.add.at(total[name], trie.node, one(name).flatten().to_numpy())
    low = np.full(trie.n, NO_ID)
    np.minimum.at(low, trie.node, one("low").flatten().to_numpy())
    chars = one("chars").flatten().to_numpy()[trie.first]
    ends = np.full(trie.n, None, object)
    for node, said in zip(trie.node.tolist(), one("ends").flatten().to_pylist()):
        ends[node] = ends[node] or said
    # A spine's leaf is a leaf if no shard put another node below it.
    leaf = trie.leaf & (total["children"] == 0)
    leaves = total["leaves"] + trie.sums(leaf.astype(np.int64))
    saved = total["saved"] + trie.sums((total["members"] - 1) * chars)
    children = total["children"] + np.bincount(trie.parent[trie.parent >= 0], minlength=trie.n)
    top = trie.parent < 0
    parent = np.where(top, NO_ID, low[trie.parent])
    yield from pa.Table.from_arrays(
        [pa.array([k.tobytes() for k in trie.key], pa.binary()), _ids(low), pa.array(trie.depth), _ids(parent),
         pa.array(total["members"]), pa.array(children), pa.array(leaves), pa.array(saved),
         pa.array([e or NO_ENDS for e in ends], pa.string())],
        names=["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               "ends_sha256"]).to_batches()


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix hashes of each conversation's turns."""
    for batch in batches:
        paths, chars = [], []
        for turns in batch.column("turns").to_pylist():
            at, path = ROOT, [ROOT]
            for turn in turns:
                at = hashlib.sha256(at + turn["hash"]).digest()[:16]
                path.append(at)
            paths.append(path)
            chars.append([0, *[turn["chars"] for turn in turns]])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(paths, pa.list_(pa.binary())), pa.array(chars, pa.list_(pa.int64()))],
            names=["conv_id", "path", "chars"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (last, conv_id) rows as rows of at most IDS_PER_CHUNK ids of one node."""
    for batch in batches:
        last, ids = batch.column("last").to_pylist(), batch.column("conv_id").to_pylist()
        out, start = [], 0
        for i in range(1, len(last) + 1):
            if i == len(last) or last[i] != last[start] or i - start == IDS_PER_CHUNK:
                out.append((last[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.string())], names=["last", "first_id", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its sorted chunks; only the running hash is held."""
    node, running = None, None
    for batch in batches:
        done = []
        for last, ids in zip(batch.column("last").to_pylist(), batch.column("ids").to_pylist()):
            if last != node:
                if running is not None:
                    done.append((node, running.hexdigest()))
                node, running = last, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["last", "ends"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([running.hexdigest()])], names=["last", "ends"])


def end_digests(paths: DataFrame) -> DataFrame:
    """(last, ends) per node where conversations end: the digest of their ids, ascending.

    Ids are sorted over all partitions and packed first; a digest over a list is one
    running hash, so a node's packed ids (and nothing else) pass one task as a stream.
    """
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    light = paths.select("last", "conv_id").filter(F.col("conv_id").isNotNull())
    packed = (light.repartitionByRange(n, "last", "conv_id").sortWithinPartitions("last", "conv_id")
              .mapInArrow(_chunks, "last binary, first_id long, ids string"))
    return (packed.repartition(n, "last").sortWithinPartitions("last", "first_id")
            .mapInArrow(_digests, "last binary, ends string"))


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with turns as array<struct<hash, chars>> in order of turn.

    The hash covers role and text (null as empty), so texts stay behind.  Turns go by
    number (null first); ties by role, then by the SHA-256 of the text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", role.alias("role"), F.unhex(F.sha2(text, 256)).alias("tie"),
                    F.substring(F.unhex(F.sha2(both, 256)), 1, 16).alias("hash"),
                    F.length(text).cast("long").alias("chars"))
    rows = conversations.select("conv_id", turn.alias("t"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return rows.select("conv_id", F.transform("ts", lambda t: F.struct(t["hash"].alias("hash"), t["chars"].alias("chars")))
                       .alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, turns): conversation c with its first h = crc32(c) % ``heads`` turns taken from
    conversation c - c % ``every`` (all if fewer, none if absent).

    A null conv_id is one conversation, which keeps its own turns.
    """
    turns = materialize(conversation_turns(conversations), "trie-turns")
    c = F.col("conv_id")
    base = turns.filter(c % every == 0).select(
        c.alias("base"), F.slice("turns", F.lit(1), F.lit(max(heads - 1, 0))).alias("head"))
    h = F.when(c.isNull(), F.lit(0)).otherwise((F.crc32(c.cast("string").cast("binary")) % heads).cast("int"))
    rows = turns.withColumn("h", h).withColumn("base", c - c % every).join(base, "base", "left")
    none = F.slice("turns", 1, 0)
    head = F.when(F.col("head").isNull(), none).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return rows.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, turns): see :func:`conversation_turns` and :func:`rebuilt`.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 per node, the textless root included.  A null
    conv_id counts as a member, is never the smallest and is not in ends_sha256;
    conversations without turns are members of the root alone; an empty table has no
    node.  A conversation's hashes (24 bytes a turn) are one row.
    """
    ship(conversations.sparkSession)
    spark = conversations.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = conversations.select(F.col("conv_id").cast("long"), "turns").mapInArrow(
        _paths, "conv_id long, path array<binary>, chars array<long>")
    paths = materialize(paths.withColumn("last", F.element_at("path", -1)), "trie-paths")
    distinct = paths.groupBy("last", "path", "chars").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    rows = distinct.join(end_digests(paths), "last", "left").select("path", "chars", "n", "low", "ends")
    rows = materialize(rows, "trie-distinct")
    nodes = rows.repartitionByRange(shards, "path").sortWithinPartitions("path").mapInArrow(_shard, NODES)
    nodes = materialize(nodes, "trie-nodes")
    # Two paths per shard: one task, whatever the number of conversations.
    spines = (nodes.filter("spine IS NOT NULL").select("spine.*").repartition(1).sortWithinPartitions("path")
              .mapInArrow(_merge, MERGED))
    spines = materialize(spines, "trie-spines")
    above = spines.select(F.col("key").alias("up"), F.col("conv_id").alias("up_id"))
    inner = lookup(nodes.filter("spine IS NULL").drop("spine"), above, "up", ["up_id"])
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = inner.withColumn("parent_conv_id", F.coalesce("up_id", "parent_conv_id"))
    return inner.select(*out).unionByName(spines.select(*out))
