"""Removal of byte strings of `match` bytes that start anywhere else in the corpus, by merging sampled suffix orders.

Sampling: each window of `match` bytes names the smallest hashed `gram` inside it as its anchor, so equal windows have equal anchors at equal
distances. Only suffixes that start at an anchor are sorted, and only those whose anchor occurs twice.

Shards: a batch of texts sorts its anchor suffixes and keeps with them the bytes that stand before (what a Burrows-Wheeler transform stores).
Merge: the shards' runs of suffixes with one anchor meet in their order; their interleaving is refined by eight more bytes in each round, only where
it is still open, which gives the longest common prefixes as it goes. The bytes before the anchors are interleaved in the same way, read backwards.
Repeated intervals then follow by stepping backwards: after o steps the windows with o bytes before and match - o bytes after are equal exactly if they
lie in one prefix interval on either side. No pairs are made.

Frequent anchors: windows with between lo and hi bytes before the anchor agree, where they are equal, in the lo bytes before it and the match - hi bytes
after it. Those bytes deal them out, so a frequent anchor is many small groups; what is equal within a shard is one row and needs no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_table, discard, in_table, materialise, prepare, slices, spread_join

MATCH, GRAM = 400, 64
SEGMENT = 256 << 10  # bytes of one text looked at together; segments overlap by match - 1
HELD = 12 << 20  # bytes of contexts and owners that a task holds
CHUNK = 3 << 20
GROUP_ROWS = 500  # occurrences of an anchor; the windows of a more frequent one are dealt out by what they hold, in BANDS bands of their offsets
BANDS = 8
OWNER = np.dtype([("digest", "S16"), ("at", "<i8")])
SPAN = np.dtype([("digest", "S16"), ("start", "<i8"), ("stop", "<i8")])
_POSITION = 21

_BASE, _MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _cache:
        _cache.clear()
        _cache[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    ahead, back = _cache[size]
    return ahead[:n], back[:n]


def window_hashes(raw: np.ndarray, size: int, salt: int = _MIX) -> np.ndarray:
    """64-bit hash of each run of `size` bytes."""
    ahead, back = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw + np.uint64(1)) * ahead[:-1], out=sums[1:])
    out = (sums[size:] - sums[:-size]) * back[: len(raw) - size + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(salt)
    out ^= out >> np.uint64(29)
    out *= np.uint64(_BASE)
    return out ^ (out >> np.uint64(32))


def anchors(raw: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of each run of windows with one anchor, for all windows of match bytes in raw."""
    hashes = window_hashes(raw, gram)
    span = match - gram + 1
    low = np.uint64((1 << _POSITION) - 1)
    ranked = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)  # equal hashes: the leftmost
    pad = -len(ranked) % span
    grid = np.concatenate([ranked, np.full(pad, ~np.uint64(0))]).reshape(-1, span)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(raw) - match + 1
    place = (np.minimum(back[:n], ahead[span - 1 : span - 1 + n]) & low).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], n) - 1
    return hashes[place[first]], place[first], first, last


def _segments(texts: list[bytes], match: int) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray]]:
    """(which text, offset in it, offset in the buffer) of texts of match bytes and more, with their bytes one after the other."""
    held, size = [], 0

    def flush():
        spans, at = [], 0
        for i, off, part in held:
            spans.append((i, off, at))
            at += len(part)
        return spans, np.frombuffer(b"".join(p for _, _, p in held), np.uint8)

    for i, text in enumerate(texts):
        for off in range(0, len(text) - match + 1, SEGMENT - match + 1):
            part = text[off : off + SEGMENT]
            if size + len(part) > SEGMENT and held:
                yield flush()
                held, size = [], 0
            held.append((i, off, part))
            size += len(part)
    if held:
        yield flush()


def _anchor_rows(texts: list[bytes], match: int, gram: int) -> Iterator[tuple]:
    """For each buffer: bytes, and of its anchors the hash, place, first and last window, text number, that text's offset and start in the buffer."""
    for spans, raw in _segments(texts, match):
        if len(raw) < match:
            continue
        key, place, first, last = anchors(raw, match, gram)
        starts = np.array([at for _, _, at in spans])
        ends = np.append(starts[1:], len(raw))
        # a run of windows may cross texts: cut it at their ends, windows that reach into the next text do not count
        which = np.searchsorted(starts, first, "right") - 1
        until = np.searchsorted(starts, last, "right") - 1
        extra = np.flatnonzero(until > which)
        parts = [np.arange(len(key))] + [np.full(until[r] - which[r], r) for r in extra]
        row = np.concatenate(parts)
        text = np.concatenate([which] + [np.arange(which[r] + 1, until[r] + 1) for r in extra])
        lo = np.maximum(first[row], starts[text])
        hi = np.minimum(last[row], ends[text] - match)
        good = (lo <= hi) & (place[row] >= starts[text])
        row, text, lo, hi = row[good], text[good], lo[good], hi[good]
        yield raw, key[row], place[row], lo, hi, np.array([i for i, _, _ in spans])[text], np.array([o for _, o, _ in spans])[text], starts[text]


def _count(match: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "raw", 4 * SEGMENT):
            texts = [x or b"" for x in batch.column(0).to_pylist()]
            found = [r[1] for r in _anchor_rows(texts, match, gram)]
            key, n = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    return run


CONTEXTS = "key bigint, part bigint, shard bigint, rank int, anchor int, windows int, context binary, n int, owners binary"


def union_spans(spans: np.ndarray) -> np.ndarray:
    """The spans of each digest, sorted, with those that touch or overlap made one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["digest"]))]
    digest, start, stop = (spans[k] for k in SPAN.names)
    group = np.cumsum(np.append(False, digest[1:] != digest[:-1]))
    step = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + group * step)
    first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (start[1:] + group[1:] * step > reach[:-1])))
    out = spans[first]
    last = np.append(first[1:], len(spans)) - 1
    out["stop"] = reach[last] - group[last] * step
    return out


def _spans(owners: np.ndarray, first: np.ndarray, last: np.ndarray, match: int) -> np.ndarray:
    """What windows first..last - 1 (of each run of windows) cover in each owner."""
    out = np.empty(len(owners) * len(first), SPAN)
    out["digest"] = np.repeat(owners["digest"], len(first))
    out["start"] = (owners["at"][:, None] + first).reshape(-1)
    out["stop"] = (owners["at"][:, None] + last).reshape(-1) - 1 + match
    return out


def bands(anchor: int, windows: int, match: int, gram: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(first window, windows, start and end of the bytes that they share, band) of the bands of a context's windows."""
    width = -(-(match - gram + 1) // BANDS)
    for band in range(BANDS):
        most, least = min(width * (band + 1) - 1, anchor), max(width * band, anchor - windows + 1)  # bytes before the anchor
        if least <= most:
            yield anchor - most, most - least + 1, anchor - width * band, anchor + match - width * (band + 1) + 1, band


def _context(match: int, gram: int, bits):
    """Contexts of the anchors that may occur twice, equal ones of a shard in one row, in suffix order. A shard is HELD bytes of contexts of a partition.
    part is -1, or for a band of a frequent anchor's windows a hash of the bytes that they share. What stands twice in the shard is known to be repeated:
    its owners' spans are rows without context, and its own row needs no owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        repeated, frequent = bits.value
        rows: dict[tuple[int, int, bytes], list] = {}
        held, serial = 0, TaskContext.get().partitionId() << 32

        def emit(made: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names=[x.split(" ")[0] for x in CONTEXTS.split(", ")])

        def shard() -> Iterator[pa.RecordBatch]:
            spans, made = [np.zeros(0, SPAN)], []
            for rank, ((k, p, c), (a, w, n, o)) in enumerate(sorted(rows.items(), key=lambda r: (r[0][0], r[0][1], r[0][2][r[1][0] :]))):
                owners = np.array(o, OWNER)
                if n > 1:
                    spans.append(_spans(owners, np.zeros(1, np.int64), np.full(1, w), match))
                made.append((k, p, serial, rank, a, w, c, min(n, 2), b"" if n > 1 else owners.tobytes()))
                if len(made) == 5000:
                    yield emit(made)
                    made = []
            merged = union_spans(np.concatenate(spans))
            cuts = np.flatnonzero(np.append(True, merged["digest"][1:] != merged["digest"][:-1])) if len(merged) else np.zeros(0, np.int64)
            for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(merged)], strict=False):
                made.append((int.from_bytes(merged["digest"][x].ljust(8, b"\0")[:8], "little", signed=True), -1, serial, -1, 0, 0, None, 0, merged[x:y].tobytes()))
            if made:
                yield emit(made)

        def add(k: int, p: int, context: bytes, anchor: int, windows: int, owner: tuple[bytes, int]) -> int:
            mine = rows.get((k, p, context))
            if mine is None:
                rows[k, p, context] = [anchor, windows, 1, [owner]]
                return len(context) + OWNER.itemsize
            mine[2] += 1
            mine[3].append(owner)
            return OWNER.itemsize

        for batch in slices(batches, "raw", 4 * SEGMENT):
            texts = [x or b"" for x in batch.column(0).to_pylist()]
            digests: dict[int, bytes] = {}
            for raw, key, place, lo, hi, text, off, start in _anchor_rows(texts, match, gram):
                keep = np.flatnonzero(in_table(repeated, key))
                often = in_table(frequent, key[keep]).tolist()
                data = raw.tobytes()
                for k, p, a, b, t, at, many in zip(key[keep].view(np.int64).tolist(), place[keep].tolist(), lo[keep].tolist(), hi[keep].tolist(), text[keep].tolist(), (lo - start + off)[keep].tolist(), often, strict=True):
                    if t not in digests:
                        digests[t] = hashlib.sha256(texts[t]).digest()[:16]
                    context = data[a : b + match]
                    if not many:
                        held += add(k, -1, context, p - a, b - a + 1, (digests[t], at))
                        continue
                    for first, n, left, right, band in bands(p - a, b - a + 1, match, gram):
                        part = int.from_bytes(hashlib.blake2b(context[left:right], digest_size=8, salt=bytes([band])).digest(), "little") >> 1
                        held += add(k, part, context[first : first + n - 1 + match], p - a - first, n, (digests[t], at + first))
                if held >= HELD:
                    yield from shard()
                    rows, held, serial = {}, 0, serial + 1
        yield from shard()

    return run


def interleave(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, prefix): rows by group and then by their words (they come as sorted runs, which the stable sorts merge); prefix[r] is the number of equal leading bytes of rows order[r-1] and order[r]
    (-1 between groups, 8 a word where all are equal). Each round looks at one more word, and only at rows that are not yet apart."""
    n, rounds = words.shape
    order = np.argsort(group, kind="stable")
    block = group[order]
    prefix = np.where(np.diff(block, prepend=-1) != 0, -1, 8 * rounds)
    for w in range(rounds):
        inner = prefix == 8 * rounds
        open_ = np.flatnonzero(inner | np.append(inner[1:], False))
        if not len(open_):
            break
        value = words[order[open_], w]
        block = np.cumsum(~inner)[open_]
        turn = np.lexsort((value, block))
        order[open_], value = order[open_][turn], value[turn]
        apart = np.flatnonzero((value[1:] != value[:-1]) & (block[1:] == block[:-1])) + 1
        differ = value[apart] ^ value[apart - 1]
        same = sum((differ >> np.uint64(64 - 8 * k) == 0).astype(np.int64) for k in range(1, 8))
        prefix[open_[apart]] = 8 * w + same
    return order, prefix


def repeated_windows(key: np.ndarray, anchor: np.ndarray, windows: np.ndarray, contexts: list[bytes], n: np.ndarray, match: int) -> list[np.ndarray]:
    """Of each context (different ones, n times in the corpus) which of its windows stand anywhere else."""
    flat_at = np.concatenate([[0], np.cumsum(windows)])
    seen = np.repeat(n > 1, windows)
    _, group, size = np.unique(key, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(size[group] > 1)
    if len(rows):
        _, group = np.unique(group[rows], return_inverse=True)
        a, w = anchor[rows], windows[rows]
        width = -(-match // 8) * 8
        right = np.frombuffer(b"".join(contexts[r][anchor[r] : anchor[r] + match].ljust(width, b"\0") for r in rows), ">u8").reshape(len(rows), -1).astype(np.uint64)
        reach = int(a.max())
        deep = -(-reach // 8) * 8
        left = np.frombuffer(b"".join(contexts[r][: anchor[r]][::-1].ljust(deep, b"\0") for r in rows), ">u8").reshape(len(rows), deep // 8).astype(np.uint64)
        (order, prefix), (back, behind) = interleave(group, right), interleave(group, left)
        after, before = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for o in range(reach + 1):
            mine = np.flatnonzero((a >= o) & (a - o < w))
            if len(mine) < 2:
                continue
            after[order] = np.cumsum(prefix < match - o)
            before[back] = np.cumsum(behind < o)
            both = after[mine] * (len(rows) + 1) + before[mine]
            turn = np.argsort(both)
            equal = both[turn][1:] == both[turn][:-1]
            hit = np.append(equal, False) | np.append(False, equal)
            found = mine[turn[hit]]
            seen[flat_at[rows[found]] + a[found] - o] = True
    return [seen[flat_at[i] : flat_at[i + 1]] for i in range(len(key))]


FOUND = "digest binary, start bigint, stop bigint"


def _merge(match: int):
    """Rows arrive sorted by key, part, shard and rank, so a group is a row of sorted runs. Yields covered [start, stop) of texts.

    A context that comes again is repeated as a whole: its owners' spans are passed on at once, so a task holds different contexts only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(spans: list[np.ndarray]) -> pa.RecordBatch:
            merged = union_spans(np.concatenate([np.zeros(0, SPAN), *spans]))
            return pa.RecordBatch.from_arrays([pa.array([d.ljust(16, b"\0") for d in merged["digest"].tolist()], pa.binary()), pa.array(merged["start"]), pa.array(merged["stop"])], names=["digest", "start", "stop"])

        def solve(rows: dict) -> list[np.ndarray]:
            _, group = np.unique(np.array([(k, p) for k, p, _ in rows], np.int64), axis=0, return_inverse=True)
            anchor, windows, n = (np.array([r[k] for r in rows.values()], np.int64) for k in range(3))
            found = []
            for (_, _, _, owners), seen in zip(rows.values(), repeated_windows(group.reshape(-1), anchor, windows, [c for _, _, c in rows], n, match), strict=True):
                if owners and seen.any():
                    edge = np.diff(seen.astype(np.int8), prepend=0, append=0)
                    found.append(_spans(np.frombuffer(owners, OWNER), np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), match))
            return found

        rows: dict[tuple[int, int, bytes], list] = {}
        spans, size, last = [], 0, None
        for batch in batches:
            for k, p, a, w, c, n, o in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if c is None:
                    spans.append(np.frombuffer(o, SPAN))
                    size += len(o)
                    continue
                if (k, p) != last:
                    if size >= CHUNK:
                        yield table([*spans, *solve(rows)] if rows else spans)
                        rows, spans, size = {}, [], 0
                    last = k, p
                mine = rows.get((k, p, c))
                if mine is None:
                    rows[k, p, c] = [a, w, n, o]
                    size += len(c) + len(o)
                    continue
                for owners in (mine[3], o):
                    if owners:
                        spans.append(_spans(np.frombuffer(owners, OWNER), np.zeros(1, np.int64), np.full(1, w), match))
                        size += spans[-1].nbytes
                mine[2], mine[3] = 2, b""
        if rows or spans:
            yield table([*spans, *solve(rows)] if rows else spans)

    return run


def covered(texts: DataFrame, *, match: int = MATCH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """digest, spans (start, stop): the bytes of each text (column raw) that a repeated string of match bytes covers; texts without are left out."""
    spark = texts.sparkSession
    prepare(spark)
    raw = texts.select("raw")
    counts = raw.mapInArrow(_count(match, gram), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    counts = materialise(counts, "repeated-anchors")
    bits = spark.sparkContext.broadcast((bit_table(counts), bit_table(counts.where(F.col("n") > group_rows))))
    contexts = raw.mapInArrow(_context(match, gram, bits), CONTEXTS)
    runs = contexts.repartition("key", "part").sortWithinPartitions("key", "part", "shard", "rank").drop("shard", "rank")
    found = materialise(runs.mapInArrow(_merge(match), FOUND), "repeated")
    discard(counts)
    return found.groupBy("digest").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def cut_spans(raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, int, int]:
    """(bytes that stay, bytes removed, maximal removed runs)."""
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes that stay, null where all do), kept_sha256, shortened (whether any byte went) of every row.

    Null text is empty; texts shorter than match lose nothing; repeated rows are copies of one another and lose everything from match bytes on;
    null ids keep their rows."""

    @F.pandas_udf(T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())]))
    def cut(raw: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = [(None, 0, 0) if s is None else cut_spans(bytes(r), np.array([x["start"] for x in s]), np.array([x["stop"] for x in s])) for r, s in zip(raw, spans, strict=True)]
        return pd.DataFrame({"kept": pd.Series([r[0] for r in rows], dtype=object), "n_removed": pd.Series([r[1] for r in rows], dtype="int64"), "n_spans": pd.Series([r[2] for r in rows], dtype="int64")})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("raw"))
    spans = covered(texts, match=match, gram=gram, group_rows=group_rows)
    long = F.length("raw") >= match  # the others have no span to join
    digested = texts.where(long).withColumn("digest", F.substring(F.unhex(F.sha2("raw", 256)), 1, 16))
    joined = spread_join(digested, spans, "digest", "doc_id").select("doc_id", "raw", "spans")
    parts = joined.select("doc_id", "raw", cut(F.when(F.col("spans").isNotNull(), F.col("raw")), "spans").alias("c"))
    parts = parts.unionByName(texts.where(~long).select("doc_id", "raw", F.lit(None).cast(parts.schema["c"].dataType).alias("c")))
    kept, n_removed = F.col("c")["kept"], F.coalesce(F.col("c")["n_removed"], F.lit(0).cast("long"))
    return parts.select(
        "doc_id", F.length("raw").cast("long").alias("n_bytes"), n_removed.alias("n_removed"), F.coalesce(F.col("c")["n_spans"], F.lit(0).cast("long")).alias("n_spans"),
        kept.alias("kept"), F.sha2(F.when(kept.isNull(), F.col("raw")).otherwise(kept), 256).alias("kept_sha256"), (n_removed > 0).alias("shortened"),
    )
