"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Fingerprints that differ in three bits at most agree in one segment but for one bit.
Each segment is indexed as it is and with each of its bits left out; fingerprints that share a signature meet, and whether they link is verified on
all 64 bits. Inside a bucket only a spanning forest of the links is emitted, so the rows follow the fingerprints, not their pairs. A bucket of
over BLOCK fingerprints is dealt out again: what its members may differ in is cut into four parts, one of which linked fingerprints share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, prepare, spread_join

SHINGLE, SEED, MAX_BITS = 3, 42, 3
SEGMENT = 32
BLOCK = 4096  # fingerprints of a bucket linked in one task
COMPARED = 1024  # of them compared at once
LEVELS = 4  # a bucket is dealt out after each level but the last; there members share 48 bits or more, so it has 65,536 of them at most
TASK_ROWS = 50_000  # fingerprints expanded in a task


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if set in over half of the XXH64 values of the word shingles, repeats included; 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    values = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, n)
    return majority(values)


def majority(values: np.ndarray) -> int:
    """The bits that over half of the hashes have set."""
    counts, n = np.zeros(64, np.int64), len(values)
    for at in range(0, n, 1 << 16):
        counts += np.unpackbits(values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf(T.LongType())
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return fp


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint_udf(shingle)(text_col).alias("fp"))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each fingerprint: 2 whole segments (slot 32) and 2 x 32 segments with one bit left out (slot = that bit)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            fp = batch.column(0).slice(at, 2000).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = []
            for s in (0, 1):
                segment = fp >> np.uint64(SEGMENT * s) & np.uint64(0xFFFFFFFF)
                for slot in range(SEGMENT + 1):
                    kept = segment & ~np.uint64(1 << slot) if slot < SEGMENT else segment
                    keys.append(kept | np.uint64((s * (SEGMENT + 1) + slot) << SEGMENT))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fp, len(keys)).view(np.int64))], names=["key", "fp"])


def forest(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) of the links among distinct fingerprints: each member with the smallest of its component here."""
    fp = np.sort(fp)
    root = np.arange(len(fp))
    for a in range(0, len(fp), COMPARED):
        for b in range(a, len(fp), COMPARED):
            i, j = np.nonzero(np.bitwise_count(fp[a : a + COMPARED, None] ^ fp[None, b : b + COMPARED]) <= max_bits)
            i, j = i + a, j + b
            while True:  # hook roots to smaller roots, then shorten
                x, y = root[i], root[j]
                open_ = x != y
                if not open_.any():
                    break
                i, j, x, y = i[open_], j[open_], x[open_], y[open_]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (up := root[root]).tolist() != root.tolist():
                    root = up
    member = np.flatnonzero(root != np.arange(len(fp)))
    return fp[member], fp[root[member]]


def _parts(key: int, fp: np.ndarray, level: int) -> np.ndarray:
    """Keys of a large bucket's members for the next level, four of each: three differing bits leave one of four parts alike.

    The parts are the bytes of the segment that the bucket leaves free, then every fourth bit of the fingerprint, then every fourth group of four."""
    if level == 1:
        other = fp >> np.uint64(SEGMENT if key >> SEGMENT <= SEGMENT else 0)
        masks = [0xFF << 8 * k for k in range(4)]
    else:
        other = fp
        masks = [(0x1111111111111111 << k) if level == 2 else (0x000F000F000F000F << 4 * k) for k in range(4)]
    out = np.stack([(other & np.uint64(m)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((k + 1) * 0x94D049BB133111EB & (1 << 64) - 1) for k, m in enumerate(masks)])
    out = (out ^ out >> np.uint64(29) ^ np.uint64(key & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


def _link(max_bits: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by key: a bucket is a run. Yields edges (a, b), or (key, a) of the members of buckets that are dealt out again."""
        key, held, dealt = None, np.zeros(0, np.uint64), False

        def again(fp: np.ndarray) -> pa.RecordBatch:
            keys = _parts(key, fp, level).reshape(-1)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.tile(fp, 4).view(np.int64)), pa.nulls(len(keys), pa.int64())], names=["key", "a", "b"])

        def edges(key: int, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            slot = (key >> SEGMENT) % (SEGMENT + 1)
            if level == 1 and slot < SEGMENT:  # what differs elsewhere only is linked in the bucket of the whole segment
                bit = fp >> np.uint64(SEGMENT * ((key >> SEGMENT) // (SEGMENT + 1)) + slot) & np.uint64(1)
                if (bit == bit[0]).all():
                    return
            a, b = forest(fp, max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["key", "a", "b"])

        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
            ends = np.append(starts[1:], len(keys))
            if keys[0] == key:
                held, starts, ends = np.concatenate([held, fps[: ends[0]]]), starts[1:], ends[1:]
            if len(starts):
                if dealt:
                    yield again(held)
                elif len(held) > 1:
                    yield from edges(key, held)
                inner = np.flatnonzero(ends[:-1] - starts[:-1] > 1)
                for a, b in zip(starts[inner].tolist(), ends[inner].tolist(), strict=True):
                    if b - a > BLOCK and level < LEVELS:
                        key = int(keys[a])
                        yield again(fps[a:b])
                    else:
                        yield from edges(int(keys[a]), fps[a:b])
                key, held, dealt = int(keys[-1]), fps[starts[-1] :], False
            if (dealt or len(held) > BLOCK) and level < LEVELS:  # a large bucket's rows pass on as they come
                yield again(held)
                held, dealt = held[:0], True
        if dealt and len(held):
            yield again(held)
        elif len(held) > 1:
            yield from edges(key, held)

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges a, b whose components are those of all pairs of the distinct fingerprints (column fp) at max_bits or fewer differing bits."""
    if max_bits > 3:
        raise ValueError("two segments with one free bit find up to three differing bits")
    spark = prints.sparkSession
    tasks = min(100_000, max(spark.sparkContext.defaultParallelism, prints.count() // TASK_ROWS))
    keyed = prints.select("fp").repartition(tasks, "fp").mapInArrow(_signatures, "key bigint, fp bigint")
    edges = None
    for level in range(1, LEVELS + 1):
        found = materialise(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_link(max_bits, level), "key bigint, a bigint, b bigint"), "linked")
        mine = found.where("key is null and a <> b").select("a", "b")
        edges = mine if edges is None else edges.union(mine)
        if not found.where("key is not null").limit(1).count():
            break
        keyed = found.where("key is not null").select("key", F.col("a").alias("fp"))
    return edges.distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, label: the smallest node of each node's component, by hooking labels to smaller ones and shortening, a table each round.

    Only fingerprints with a link take part; a round halves the distance to the smallest at least, so the number of rounds follows the
    logarithm of the longest chain."""
    edges = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    label = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(rounds):
        near = edges.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = label.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        # the label's own label is hooked too: a whole tree moves at once
        tree = hooked.groupBy("label").agg(F.min("low").alias("tree"))
        hooked = hooked.join(tree, "label").select("node", F.least("low", "tree").alias("next"), "label")
        jump = hooked.select(F.col("node").alias("next"), F.col("next").alias("far"))
        new = materialise(hooked.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("label"), (F.least("next", F.coalesce("far", "next")) != F.col("label")).alias("moved")), "labels")
        moved = new.where("moved").limit(1).count()
        discard(label)
        label = new.drop("moved")
        if not moved:
            discard(edges)
            return label
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    component_id is the smallest doc_id reachable over links of max_bits or fewer differing bits. Null and empty texts have fingerprint zero
    and link like any other. Repeated rows and null ids keep their rows; a component of null ids alone has a null id. No rows give none."""
    prints = materialise(fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col), "prints")
    smallest = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-prints")
    label = components(links(smallest, max_bits))
    labelled = smallest.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    groups = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    by_print = labelled.join(groups, "label").select("fp", "component_id")
    return spread_join(prints, by_print, "fp", "doc_id").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
