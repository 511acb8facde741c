"""Training-order materialisation: token sequences in a keyed global order, in shards of fixed stride.

Every sequence gets a dense number (by a hash of its document, so that it doesn't depend on how the input lies in files), a keyed Feistel permutation with cycle-walking turns it into a global slot, and range partitions of slots are
written as shards. All records have the same size, so slot k is at a computed place: a reader resumes anywhere without an index.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, prepare, slices
from .tokens import encoder, tokenizer_path

SEQUENCE = 512
SHARD_SLOTS = 2048
KEY = 0x5DEECE66D
ROUNDS = 6
BUCKETS = 1 << 14  # groups of documents by a hash, each numbered in itself
MAGIC = b"TOKSHRD1"
HEADER = "<8sIIqI"  # magic, ids of a record, stride, first slot, slots
RECORD = "<qii"  # doc_id, piece, ids that are not padding
NO_ID = -(1 << 63)


def permute(index: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """Keyed bijection of 0..size-1 (Feistel network over an even number of bits, walked along its cycles until inside)."""
    half = np.uint64(max(1, -(-max(size - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [np.uint64(hash_ & ((1 << 64) - 1)) for hash_ in (key * 0x9E3779B97F4A7C15 + r * 0xBF58476D1CE4E5B9 for r in range(1, ROUNDS + 1))]
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            x = (right + k) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (x >> np.uint64(32)) & mask
        out[todo] = left << half | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _cut(path: str, length: int):
    """Rows arrive by bucket: sequences get numbers from 0 on in their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, bucket, rank = encoder(path), None, 0
        for batch in slices(batches, "text", 4 << 20):
            buckets, ranks, records = [], [], []
            for own, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), code.all_ids(batch.column(2).to_pylist()), strict=True):
                if own != bucket:
                    bucket, rank = own, 0
                raw, n = ids.astype("<u2", copy=False).tobytes(), max(1, -(-len(ids) // length))
                for k in range(n):
                    part = raw[2 * length * k : 2 * length * (k + 1)]
                    records.append(struct.pack(RECORD, NO_ID if doc is None else doc, k, len(part) // 2) + part)
                buckets += [own] * n
                ranks += range(rank, rank + n)
                rank += n
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(ranks, pa.int64()), pa.array(records, pa.binary())], names=["bucket", "rank", "record"])

    return run


def _shards(length: int, slots: int):
    stride = struct.calcsize(RECORD) + 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by slot and a shard is whole in its partition; records are filled up to the stride here."""
        shard, first, held = None, 0, []

        def close() -> pa.RecordBatch:
            head = struct.pack(HEADER, MAGIC, length, stride, first, len(held))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([head + b"".join([r.ljust(stride, b"\0") for r in held])], pa.binary())], names=["shard", "data"])

        for batch in batches:
            for slot, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if slot // slots != shard:
                    if held:
                        yield close()
                    shard, first, held = slot // slots, slot, []
                if slot != first + len(held):
                    raise ValueError(f"slot {first + len(held)} is missing")
                held.append(record)
        if held:
            yield close()

    return run


def read_shard(data: bytes, start: int | None = None, count: int | None = None) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(slot, doc_id, piece, ids) from global slot `start` on: only the bytes of those slots are touched."""
    magic, length, stride, first, n = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("not a shard of token sequences")
    low = max(0, (first if start is None else start) - first)
    for k in range(low, n if count is None else min(n, low + count)):
        at = struct.calcsize(HEADER) + k * stride
        doc, piece, used = struct.unpack_from(RECORD, data, at)
        yield first + k, None if doc == NO_ID else doc, piece, np.frombuffer(data, "<u2", used, at + struct.calcsize(RECORD))


def _list(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = [(doc, piece, len(ids), slot, slot // slots, zlib.crc32(ids.astype("<u4").tobytes())) for slot, doc, piece, ids in read_shard(data.as_py())]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "piece", "length", "slot", "shard", "ids_crc32"])

    return run


def write_shards(docs: DataFrame, *, key: int = KEY, length: int = SEQUENCE, slots: int = SHARD_SLOTS, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """shard, data: the shards of all sequences, in a table of the shared folder.

    A document is cut into sequences of `length` ids, the last one padded with zeros; null and empty texts are one sequence without ids. Repeated
    rows and null ids are sequences like any other; no rows give no shards. The order depends on the key and on the documents (id and text) alone:
    a run over the same rows in other files or partitions writes the same shards, so a place to resume from stays valid."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.xxhash64("doc_id", "text")
    dealt = texts.select(F.pmod(digest, F.lit(BUCKETS)).cast("int").alias("bucket"), "doc_id", "text", digest.alias("digest"))
    sorted_ = dealt.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "digest").select("bucket", "doc_id", "text")
    sequences = materialise(sorted_.mapInArrow(_cut(tokenizer or tokenizer_path(), length), "bucket int, rank bigint, record binary"), "sequences")
    counted = sequences.groupBy("bucket").agg(F.count("*").alias("n")).toArrow()  # BUCKETS rows at most
    sizes = np.zeros(BUCKETS + 1, np.int64)
    sizes[counted.column("bucket").to_numpy() + 1] = counted.column("n").to_numpy()
    base, total = spark.sparkContext.broadcast(np.cumsum(sizes)), int(sizes.sum())

    @F.pandas_udf(T.LongType())
    def to_slot(bucket: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(permute(base.value[bucket.to_numpy()] + rank.to_numpy(), total, key))

    placed = sequences.withColumn("slot", to_slot("bucket", "rank")).select("slot", "record", F.floor(F.col("slot") / slots).alias("shard"))
    ordered = placed.repartitionByRange("shard").sortWithinPartitions("slot").select("slot", "record")
    shards = materialise(ordered.mapInArrow(_shards(length, slots), "shard bigint, data binary"), "shards")
    discard(sequences)
    return shards


def list_shards(shards: DataFrame, slots: int = SHARD_SLOTS) -> DataFrame:
    """doc_id, piece, length, slot, shard, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers) of every sequence, read back."""
    prepare(shards.sparkSession)
    return shards.select("data").mapInArrow(_list(slots), "doc_id bigint, piece int, length int, slot bigint, shard bigint, ids_crc32 bigint")


def read_from(shards: DataFrame, slot: int, count: int, slots: int = SHARD_SLOTS) -> DataFrame:
    """The shards that hold `count` slots from `slot` on, in order: what a resumed reader opens."""
    return shards.where(F.col("shard").between(slot // slots, (slot + count - 1) // slots)).orderBy("shard")
