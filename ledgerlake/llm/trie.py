"""Prefix trie of conversations, by double arrays.

A turn is known by 20 bytes: 16 of the SHA-256 of its role and text, then the code points of its text. A conversation is the row of its turns' bytes.
The rows are range-partitioned in their own order (equal ones by conv_id), so a shard holds the conversations of a range of prefixes and a prefix that
many share is split like any other. Each shard numbers its distinct turns densely and packs a double array over them: the child of node s by turn c stands
at BASE[s] + c, and CHECK there names s. Walking all its conversations through the arrays visits the nodes and sums them up.

Only nodes on the way to a shard's first and last conversation can lie in other shards too. These upper nodes are merged globally: members are added
up, the shard of least number owns the node itself, and sums over subtrees follow from each shard's share of them, bottom up along those two ways.
All other nodes are final in their shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, prepare, spread_join

WIDTH = 20  # bytes of a turn
SHARD_ROWS = 20_000  # conversations of a shard
TRIES = 256  # holes that a group of siblings is tried at before it goes to the end
BLOCK, SHARED = 100, 6  # conversations that share the beginning of their first one; a beginning has fewer turns than this
PARTS = "kind string, shard bigint, key binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, size bigint, ends string"
_KINDS = [pa.string(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]


def turns(convs: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and turns (an array of hex strings of 20 bytes), in order of turn (null first; ties by the bytes). Rows without a conv_id are no conversation's."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    known = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    turn = F.struct(F.col(turn_col).alias("turn"), F.concat(known, F.lower(F.lpad(F.hex(F.length(text)), 8, "0"))).alias("bytes"))
    rows = convs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return rows.select("conv_id", F.transform("turns", lambda x: x["bytes"]).alias("turns"))


def rebuilt(own: DataFrame, *, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """Each conversation with its first h turns taken from the first of its block of conversations, h = crc32 of its number modulo `shared`."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared)).cast("int")
    first = own.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_first"), F.slice("turns", 1, shared - 1).alias("_begin"))
    joined = own.withColumn("_h", h).withColumn("_first", F.col("conv_id") - F.col("conv_id") % block).join(first, "_first", "left")
    begin = F.when(F.col("_begin").isNotNull() & (F.col("_h") > 0), F.slice("_begin", F.lit(1), F.col("_h"))).otherwise(F.array().cast("array<string>"))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return joined.select("conv_id", F.concat(begin, rest).alias("turns"))


class DoubleArray:
    """BASE and CHECK over dense codes 0 .. codes - 1, filled level by level. Node 0 is the root; CHECK holds the parent's place + 1, 0 where free."""

    def __init__(self, codes: int) -> None:
        self.base, self.check = np.zeros(codes + 1, np.int64), np.zeros(codes + 1, np.int64)
        self.check[0] = -1
        self.end = codes + 1  # children stand behind the largest code, which keeps BASE positive
        self.holes = np.zeros(0, np.int64)

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base, self.check = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.base, self.check))

    def add(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The places of children (parent, code), each pair once, sorted by both; a parent's children come in one call."""
        starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(parent) else np.zeros(0, np.int64)
        counts = np.diff(np.append(starts, len(parent)))
        place = np.zeros(len(parent), np.int64)
        for a, n in zip(starts[counts > 1].tolist(), counts[counts > 1].tolist(), strict=True):
            offset = code[a : a + n] - code[a]
            at = self._fit(offset)
            place[a : a + n] = at + offset
            self.base[parent[a]] = at - code[a]
            self.check[place[a : a + n]] = parent[a] + 1
        one = starts[counts == 1]  # an only child takes any hole
        filled = self.holes[: len(one)][self.check[self.holes[: len(one)]] == 0]
        self.holes = self.holes[len(one) :]
        new = np.arange(self.end, self.end + len(one) - len(filled))
        self.end += len(new)
        self._grow(self.end)
        place[one] = np.concatenate([filled, new])
        self.base[parent[one]], self.check[place[one]] = place[one] - code[one], parent[one] + 1
        return place

    def _fit(self, offset: np.ndarray) -> int:
        span = int(offset[-1]) + 1
        self.holes = self.holes[self.check[self.holes] == 0] if len(self.holes) < 4 * TRIES else self.holes
        near = self.holes[:TRIES]
        near = near[near + span <= self.end]
        if len(near) * len(offset) <= TRIES * TRIES:
            for at in near.tolist():
                if not self.check[at + offset].any():
                    return at
        at = self.end
        self.end += span
        self._grow(self.end)
        inside = np.ones(span, bool)
        inside[offset] = False
        self.holes = np.concatenate([self.holes, at + np.flatnonzero(inside)])
        return at

    def step(self, place: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The children of nodes by their codes; -1 where there is none."""
        to = self.base[place] + code
        inside = (to > 0) & (to < self.end)
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == place + 1), to, -1)


def build(rows: list[bytes]) -> tuple[DoubleArray, np.ndarray, np.ndarray, np.ndarray]:
    """The double array of rows of turns, with the distinct turns, all rows' codes one after the other, and each row's number of turns."""
    lengths = np.array([len(x) // WIDTH for x in rows], np.int64)
    distinct, codes = np.unique(np.frombuffer(b"".join(rows), f"S{WIDTH}"), return_inverse=True)
    trie, starts = DoubleArray(len(distinct)), np.cumsum(lengths) - lengths
    live, place, depth = np.flatnonzero(lengths > 0), np.zeros(len(rows), np.int64), 0
    while len(live):
        code = codes[starts[live] + depth]
        pairs, at = np.unique(np.stack([place[live], code], axis=1), axis=0, return_inverse=True)
        place[live] = trie.add(pairs[:, 0], pairs[:, 1])[at.ravel()]
        depth += 1
        live = live[lengths[live] > depth]
    return trie, distinct, codes, lengths


def walk(rows: list[bytes], convs: np.ndarray) -> pd.DataFrame:
    """The nodes of rows, in order of depth: place, up (its parent's row here), depth, n_convs, conv_id, size (code points of its last turn), ends (the last rows' numbers)."""
    trie, distinct, codes, lengths = build(rows)
    sizes = np.array([int.from_bytes(x[16:].ljust(4, b"\0"), "big") for x in distinct.tolist()], np.int64)
    starts, place = np.cumsum(lengths) - lengths, np.zeros(len(rows), np.int64)
    number = np.full(trie.end + 1, -1, np.int64)
    number[0] = 0
    levels = [(np.zeros(1, np.int64), np.full(1, -1), 0, np.array([len(rows)]), np.array([convs.min()]), np.zeros(1, np.int64))]
    live, depth, made = np.flatnonzero(lengths > 0), 0, 1
    while len(live):
        code = codes[starts[live] + depth]
        place[live] = to = trie.step(place[live], code)
        if (to < 0).any():
            raise RuntimeError("a conversation left its trie")
        nodes, first, at = np.unique(to, return_index=True, return_inverse=True)
        least = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(least, at, convs[live])
        levels.append((nodes, number[trie.check[nodes] - 1], depth + 1, np.bincount(at, minlength=len(nodes)), least, sizes[code[first]]))
        number[nodes] = np.arange(made, made + len(nodes))
        made += len(nodes)
        depth += 1
        live = live[lengths[live] > depth]
    out = pd.DataFrame({k: np.concatenate([np.full(len(x[0]), x[j]) if k == "depth" else x[j] for x in levels]) for j, k in enumerate(("place", "up", "depth", "n_convs", "conv_id", "size"))})
    return out.assign(last=pd.Series(np.arange(len(rows))).groupby(number[place]).agg(list)), number[place]


def way(row: bytes) -> list[bytes]:
    """Global keys of the nodes on a row's way, root first: the depth and 16 bytes of the SHA-256 of the turns so far."""
    state, out = hashlib.sha256(), []
    for d in range(len(row) // WIDTH + 1):
        if d:
            state.update(row[(d - 1) * WIDTH : d * WIDTH])
        out.append(d.to_bytes(8, "big") + state.copy().digest()[:16])
    return out


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, row, conv_id) of one shard, sorted -> its final nodes ("node"), its part of upper ones ("open") and of what ends there ("ends")."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows, convs = [x for b in held for x in b.column("row").to_pylist()], np.concatenate([b.column("conv_id").to_numpy() for b in held])
    shard = held[0].column("shard")[0].as_py()
    del held
    nodes, end = walk(rows, convs)
    n, up = len(nodes), nodes["up"].to_numpy()
    key: list[bytes | None] = [None] * n
    for k in (0, -1):  # the two ways: from the node at which the row ends up to the root
        at = int(end[k])
        for known in reversed(way(rows[k])):
            key[at], at = known, int(up[at])
    opened = np.array([x is not None for x in key])
    saved = np.where(opened, 0, (nodes["n_convs"].to_numpy() - 1) * nodes["size"].to_numpy())
    children = np.bincount(up[1:][~opened[1:]], minlength=n)  # final ones; a final node has no others
    leaves = np.where(opened, 0, (children == 0).astype(np.int64))
    depths = nodes["depth"].to_numpy()
    cuts = np.searchsorted(depths, np.arange(depths[-1] + 2))
    for d in range(int(depths[-1]), 0, -1):  # sums go up, but not out of an upper node: its shards' shares are told apart later
        own = np.arange(cuts[d], cuts[d + 1])
        own = own[~opened[own]]
        np.add.at(saved, up[own], saved[own])
        np.add.at(leaves, up[own], leaves[own])
    conv, above = nodes["conv_id"].to_numpy(), np.maximum(up, 0)
    ends = [",".join(map(str, sorted(convs[x].tolist()))) if isinstance(x, list) else "" for x in nodes["last"]]
    parents = [key[x] for x in above.tolist()]
    known = opened[above] | (up < 0)
    columns = [
        np.where(opened, "open", "node"), np.full(n, shard), key, [p if k and u >= 0 else None for p, k, u in zip(parents, known.tolist(), up.tolist(), strict=True)], depths, conv,
        pd.Series(conv[above], dtype="Int64").mask(pd.Series(known)), nodes["n_convs"], children, leaves, saved, nodes["size"],
        [None if o else hashlib.sha256(e.encode()).hexdigest() for o, e in zip(opened.tolist(), ends, strict=True)],
    ]
    names = [x.split()[0] for x in PARTS.split(", ")]
    for a in range(0, n, 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 10_000], kind, from_pandas=True) for x, kind in zip(columns, _KINDS, strict=True)], names=names)
    parts = [(int(x), ends[x]) for x in np.flatnonzero(opened).tolist() if ends[x]]
    least = {x: int(convs[nodes["last"][x]].min()) for x, _ in parts}
    blank = {c: [None] * len(parts) for c in names} | {"kind": ["ends"] * len(parts), "shard": [shard] * len(parts), "key": [key[x] for x, _ in parts], "conv_id": [least[x] for x, _ in parts], "ends": [e for _, e in parts]}
    yield pa.RecordBatch.from_arrays([pa.array(blank[c], kind) for c, kind in zip(names, _KINDS, strict=True)], names=names)


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, conv_id, ends), sorted -> the hash of each key's numbers, comma-joined, read as they come."""
    key, state = None, None
    for batch in batches:
        out = []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k != key:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], names=["key", "ends"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends"])


def _shares(open_: pd.DataFrame) -> pd.DataFrame:
    """Of one shard's upper nodes: its share of the sums over each one's subtree, from the deepest up."""
    open_ = open_.sort_values("depth", ascending=False, ignore_index=True)
    at = {bytes(k): j for j, k in enumerate(open_["key"])}
    saved, leaves = open_["saved"].to_numpy().copy(), open_["n_leaves"].to_numpy().copy()
    for j, p in enumerate(open_["parent"]):
        if p is not None:
            saved[at[bytes(p)]] += saved[j]
            leaves[at[bytes(p)]] += leaves[j]
    return pd.DataFrame({"key": open_["key"], "saved": saved, "n_leaves": leaves})


def prefix_nodes(sequences: DataFrame, *, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node of the trie of sequences (conv_id, turns as turns() gives them).

    conv_id is the smallest member. No sequences give no nodes; a sequence without turns ends at the root."""
    spark = sequences.sparkSession
    prepare(spark)
    rows = materialise(sequences.select("conv_id", F.unhex(F.array_join("turns", "")).alias("row")), "sequences")
    shards = max(spark.sparkContext.defaultParallelism, -(-rows.count() // shard_rows))
    dealt = rows.repartitionByRange(shards, "row", "conv_id").sortWithinPartitions("row", "conv_id").withColumn("shard", F.spark_partition_id().cast("long"))
    parts = materialise(dealt.mapInArrow(_shard, PARTS), "parts")
    discard(rows)
    opened = parts.where("kind = 'open'")
    merged = opened.groupBy("key").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("final"), F.first("size").alias("size"), F.min("shard").alias("owner"))
    merged = materialise(merged, "upper")
    below = merged.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("upper"))
    whole = materialise(merged.join(below, "key", "left").withColumn("n_children", F.col("final") + F.coalesce("upper", F.lit(0))).drop("final", "upper"), "upper")
    discard(merged)
    own = whole.select("key", F.col("owner").alias("shard"), ((F.col("n_convs") - 1) * F.col("size")).alias("own_saved"), (F.col("n_children") == 0).cast("long").alias("own_leaf"))
    shared = opened.select("shard", "key", "parent", "depth", "saved", "n_leaves").join(own, ["key", "shard"], "left")
    shared = shared.select("shard", "key", "parent", "depth", (F.col("saved") + F.coalesce("own_saved", F.lit(0))).alias("saved"), (F.col("n_leaves") + F.coalesce("own_leaf", F.lit(0))).alias("n_leaves"))
    sums = shared.groupBy("shard").applyInPandas(_shares, "key binary, saved bigint, n_leaves bigint").groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves"))
    ends = parts.where("kind = 'ends'").select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_join_ends, "key binary, ends string")
    upper = whole.join(sums, "key").join(ends, "key", "left").select("key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends"))
    final = parts.where("kind = 'node'").select("parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")
    nodes = upper.drop("key").withColumn("parent_conv_id", F.lit(None).cast("long")).unionByName(final)
    named = spread_join(nodes, whole.select(F.col("key").alias("parent"), F.col("conv_id").alias("_above")), "parent", "conv_id")
    return named.select("conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
