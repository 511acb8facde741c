"""Exact duplicates by an exchange of Golomb-coded fingerprints.

A sender, a part of the table of fingerprints, sorts its own, and sends each owner of a range of them the gaps between them, Golomb-coded: about two bits
more than the logarithm of the mean gap. An owner merges what its senders sent and answers each with a bitmap of those that others sent too. Only rows
whose fingerprint occurs twice are suspects; their texts alone are shuffled, where grouping by the bytes decides. A sender sends a fingerprint once,
however many of its rows have it, and the grouping is summed before the shuffle, so a large group of copies is one row from each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, may_have, prepare, spread_join

BITS = 48  # of a fingerprint; more of them only make fewer false suspects
SENDER_ROWS = 1 << 20  # rows whose fingerprints are sorted at once
OWNER_ROWS = 1 << 20  # fingerprints that an owner gets on average
SPACES = r"[\x20\x09-\x0D]+"
SENT = "owner bigint, sender bigint, low bigint, span bigint, n bigint, code binary, rows bigint, row_at binary, row_id binary, row_null binary, row_sha binary"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def golomb_encode(gaps: np.ndarray, m: int) -> bytes:
    """Golomb code of gaps with parameter m: the remainders of one width below, the quotients in unary behind them, least bit first.

    The remainder takes the bits that m - 1 needs, in a stream of its own, so that all numbers are coded at once."""
    width = (m - 1).bit_length()
    high, low = np.divmod(gaps.astype(np.uint64), np.uint64(m))
    rest = (low[:, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel()
    unary = np.zeros(int(high.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(high.astype(np.int64) + 1) - 1] = 1
    return np.packbits(np.concatenate([rest, unary]), bitorder="little").tobytes()


def golomb_decode(code: bytes, n: int, m: int) -> np.ndarray:
    """The n gaps of golomb_encode."""
    width = (m - 1).bit_length()
    bits = np.unpackbits(np.frombuffer(code, np.uint8), bitorder="little")
    low = np.zeros(n, np.uint64)
    for k in range(width):
        low |= bits[k : n * width : width].astype(np.uint64) << np.uint64(k)
    ends = np.flatnonzero(bits[n * width :])[:n]
    return (np.diff(ends, prepend=-1) - 1).astype(np.uint64) * np.uint64(m) + low


def parameter(span: int, n: int) -> int:
    """The Golomb parameter for n fingerprints spread evenly over span."""
    return max(1, round(0.69 * span / max(1, n)))


def decoded(code: bytes, n: int, low: int, span: int) -> np.ndarray:
    """A sender's fingerprints of one owner, ascending."""
    return np.cumsum(golomb_decode(code, n, parameter(span, n)), dtype=np.uint64) + np.uint64(low)


def _send(owners: int, bits: int):
    """(part, fp, id, sha) -> what the part sends, a row for each owner: distinct fingerprints coded, and the rows that wait for the answer."""
    bounds = np.array([(1 << bits) * k // owners for k in range(owners + 1)], np.uint64)

    def flush(held: list[pa.RecordBatch], part: int, turn: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        fp = table.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(fp, kind="stable")
        fp, ids = fp[order], table.column("id").combine_chunks().take(pa.array(order))
        null, ids = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), ids.fill_null(0).to_numpy()
        sha = np.frombuffer(b"".join(table.column("sha").to_pylist()), np.uint8).reshape(-1, 32)[order]
        distinct, at = np.unique(fp, return_inverse=True)
        cut, row_cut = np.searchsorted(distinct, bounds), np.searchsorted(fp, bounds)
        out = []
        for k in np.flatnonzero(np.diff(cut)).tolist():
            own, rows, low, span = distinct[cut[k] : cut[k + 1]], slice(row_cut[k], row_cut[k + 1]), int(bounds[k]), int(bounds[k + 1] - bounds[k])
            code = golomb_encode(np.diff(own, prepend=np.uint64(low)), parameter(span, len(own)))
            places = (at[rows] - cut[k]).astype(np.int32)
            out.append((k, part << 20 | turn, low, span, len(own), code, rows.stop - rows.start, places.tobytes(), ids[rows].tobytes(), null[rows].tobytes(), sha[rows].tobytes()))
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SENT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, part, turn = [], 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                held.append(batch)
                n += batch.num_rows
            if n >= SENDER_ROWS:
                yield flush(held, part, turn)
                held, n, turn = [], 0, turn + 1
        if held:
            yield flush(held, part, turn)

    return run


def _answer(sent: pd.DataFrame) -> pd.DataFrame:
    """Of one owner: a bitmap for each sender, set where another sender has the fingerprint too."""
    own = [decoded(*x) for x in zip(sent["code"], sent["n"], sent["low"], sent["span"], strict=True)]
    _, at, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    parts = np.split(counts[at] > 1, np.cumsum([len(x) for x in own])[:-1])
    return pd.DataFrame({"owner": sent["owner"], "sender": sent["sender"], "bitmap": [np.packbits(x, bitorder="little").tobytes() for x in parts]})


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each sender and owner with what the bitmap and the sender's own repeats say: id, sha, row, fp, suspect."""
    for batch in batches:
        for x in batch.to_pylist():
            fp, at = decoded(x["code"], x["n"], x["low"], x["span"]), np.frombuffer(x["row_at"], np.int32)
            twice = np.unpackbits(np.frombuffer(x["bitmap"], np.uint8), count=x["n"], bitorder="little").astype(bool) | (np.bincount(at, minlength=x["n"]) > 1)
            ids = pa.array(np.frombuffer(x["row_id"], np.int64), mask=np.frombuffer(x["row_null"], np.uint8).astype(bool))
            sha = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), x["rows"], [None, pa.py_buffer(x["row_sha"])]).cast(pa.binary())
            row = pa.array(np.full(x["rows"], x["sender"], np.int64)), pa.array(np.arange(x["rows"], dtype=np.int64) << 24 | x["owner"])
            yield pa.RecordBatch.from_arrays([ids, sha, *row, pa.array(fp[at].view(np.int64)), pa.array(twice[at])], names=["id", "sha", "row_a", "row_b", "key", "suspect"])


def find_copies(docs: DataFrame, *, bits: int = BITS, owner_rows: int = OWNER_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs.

    Texts are equal when their bytes are after each run of white space became one space; null is empty. Of equal texts one row is kept, that with the
    smallest doc_id (ids before null; of rows with that id too, any one), and keep_id is its id. No rows give none."""
    spark = docs.sparkSession
    prepare(spark)
    text = normalised(F.col(text_col))
    mark = F.shiftrightunsigned(F.xxhash64(text), 64 - bits)
    prints = materialise(docs.select(F.col(id_col).cast("long").alias("id"), mark.alias("fp"), F.unhex(F.sha2(text, 256)).alias("sha")), "prints")
    owners = max(1, -(-prints.count() // owner_rows))
    if owners >= 1 << 24:
        raise ValueError("more than 2^24 owners; raise owner_rows")
    sent = materialise(prints.select(F.spark_partition_id().cast("long").alias("part"), "fp", "id", "sha").mapInArrow(_send(owners, bits), SENT), "sent")
    answers = sent.select("owner", "sender", "low", "span", "n", "code").groupBy("owner").applyInPandas(_answer, "owner bigint, sender bigint, bitmap binary")
    told = materialise(sent.join(answers, ["owner", "sender"]).mapInArrow(_told, "id bigint, sha binary, row_a bigint, row_b bigint, key bigint, suspect boolean"), "told")
    discard(prints)
    discard(sent)
    suspects = told.where("suspect")
    may_be = may_have(spark, suspects.select("key").distinct())
    texts = docs.select(text.alias("text"), mark.alias("fp")).where(may_be("fp"))
    same = texts.groupBy("text").agg(F.count("*").alias("n")).select(F.unhex(F.sha2("text", 256)).alias("sha"), "n")
    groups = same.groupBy("sha").agg(F.sum("n").alias("group_size"), F.count("*").alias("texts"))
    # two texts of one SHA-256 would be told apart here and raise, rather than pass for copies
    groups = groups.select("sha", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.col("group_size")).cast("long").alias("group_size"))
    first = suspects.groupBy("sha").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "row_a", "row_b")).alias("first"))
    settled = materialise(first.join(groups, "sha").select("sha", "first", "group_size"), "copies")
    own = F.col("first.row_a").eqNullSafe(F.col("row_a")) & F.col("first.row_b").eqNullSafe(F.col("row_b"))
    found = spread_join(suspects, settled, "sha", "row_b").select("id", F.col("first.id").alias("keep_id"), "group_size", own.alias("kept"), "sha")
    alone = told.where("not suspect").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return alone.unionByName(found).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
