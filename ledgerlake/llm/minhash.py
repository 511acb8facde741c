"""The near-duplicate stage of the corpus pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are linked.

Candidates come from the SimHash operator (fingerprints of the shingles within three bits, by deletion-variant signatures) and, since most pairs at 0.8
differ in more bits than that, from bands of MinHash values: a pair at 0.8 shares a band with a chance of 0.9996, a more similar pair with a higher one.
Each candidate is verified on the whole sets of shingles; texts with equal sets stand for one another.

A bucket of a band is searched in rounds. The members of its largest group so far need no search among themselves; of the rest some are drawn as
queries, four times as many in each round, and meet all members in blocks, so no task holds a bucket. A member asks for its best pairs with other groups
by the share of equal MinHash values, one in the first round and four times as many in each later one. What is verified joins groups, so a large group
of copies is one group after a round or two. A bucket is done once all of its rest have been queries and no pair between two groups is left that could
reach the similarity: nothing is given up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_bytes, discard, fresh, materialise, may_have, prepare, spread_join
from .decontam import grams, hash_words
from .simhash import components, links, majority

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 20, 5
SLACK = 0.13  # over three standard deviations of an estimate by 100 values
QUERIES, MEMBERS = 256, 1024  # that meet in a task
SMALL = 1 << 12  # pairs compared in one step
DRAWN, GROWTH = 64, 4  # queries of a bucket in the first round, and how much more of them and of pairs a member there are in the next
EDGES = 500  # pairs of one text verified in a task
BATCH_BYTES = 32 << 20  # of texts that a Python worker gets at once
SHORT_ROUNDS = 2  # before what is left gets long sketches
LONG = 4096  # bits of these
LONG_SLACK = 4  # standard deviations of their differing bits
STEP = 1 << 11  # shingles hashed at once
_LOWER = bytes(32 if c in b" \t\n\r\x0b\x0c" else c for c in range(256))
_RNG = np.random.default_rng(42)
_MUL = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of words, or of the whole text where it has fewer words."""
    words, _ = hash_words([(text or "").encode("utf-8", "surrogatepass").lower().translate(_LOWER)])
    return np.unique(grams(words, min(shingle, len(words)))) if len(words) else np.zeros(0, np.uint64)


def signature(values: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of the hash functions, upper 32 bits."""
    low = np.full(len(_MUL), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), STEP):
        mixed = values[at : at + STEP, None] * _MUL + _ADD
        low = np.minimum(low, (mixed.min(axis=0) >> np.uint64(32)).astype(np.uint32))
    return low


@lru_cache(maxsize=1)
def _long_hashes() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(43)
    return rng.integers(0, 1 << 63, LONG, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, LONG, np.uint64)


def long_sketch(values: np.ndarray) -> bytes:
    """One bit of the smallest value of the set under each of LONG hash functions."""
    mul, add = _long_hashes()
    low = np.full(LONG, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 256):
        np.minimum(low, (values[at : at + 256, None] * mul + add).min(axis=0), out=low)
    return np.packbits((low >> np.uint64(20) & np.uint64(1)).astype(np.uint8)).tobytes()


def most_differing(least: float) -> float:
    """Bits in which the long sketches of two sets of similarity `least` differ at most: half of the values that aren't common, and LONG_SLACK deviations."""
    share = (1 - least) / 2
    return LONG * share + LONG_SLACK * (LONG * share * (1 - share)) ** 0.5


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _sketch(shingle: int):
    @F.pandas_udf(T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.BinaryType()), T.StructField("fp", T.LongType())]))
    def sketch(texts: pd.Series) -> pd.DataFrame:
        digests, sketches, prints = [], [], np.zeros(len(texts), np.uint64)
        for k, text in enumerate(texts):  # one set at a time
            values = shingles(text, shingle)
            digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            sketches.append(signature(values).tobytes())
            prints[k] = majority(values) if len(values) else 0
        return pd.DataFrame({"digest": pd.Series(digests, dtype=object), "sketch": pd.Series(sketches, dtype=object), "fp": pd.Series(prints.view(np.int64))})

    return sketch


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each sketch one key a band, with the sketch's values shortened to a byte each."""
    step = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            rows = part.column(0).to_numpy(zero_copy_only=False)
            sketch = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(len(rows), BANDS, BAND_ROWS)
            keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(rows), BANDS)) * step
            for k in range(BAND_ROWS):
                keys = (keys ^ keys >> np.uint64(31)) * step + sketch[:, :, k]
            short = [x.tobytes() for x in (sketch & np.uint32(255)).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(rows, BANDS)), pa.array([x for x in short for _ in range(BANDS)], pa.binary())], names=["key", "row", "sketch"])


def alike_values(queries: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Of each pair of sketches the number of equal bytes, or of equal bits where they are words of 64."""
    if queries.dtype == np.uint8 and len(queries) * len(members) <= SMALL:
        return (queries[:, None] == members).sum(axis=2)
    same = np.zeros((len(queries), len(members)), np.int16)  # value by value, which bounds what stands in memory
    for k in range(queries.shape[1]):
        same += queries[:, k, None] == members[None, :, k] if queries.dtype == np.uint8 else 64 - np.bitwise_count(queries[:, k, None] ^ members[None, :, k]).astype(np.int16)
    return same


def best_pairs(queries: np.ndarray, members: np.ndarray, most: int, least: float) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of (query, member) pairs of different groups whose sketches share `least` values, and whether there are more of them.

    Rows are (row, label, sketch). Each member's `most` best queries count, and of two groups the `most` best pairs."""
    same = alike_values(queries["sketch"], members["sketch"])
    q, m = np.nonzero((same >= least) & (queries["label"][:, None] != members["label"][None, :]))
    value = same[q, m]
    order = np.lexsort((queries["row"][q], -value, m))
    q, m, value = q[order], m[order], value[order]
    first = _rank(m) < most
    q, m, value = q[first], m[first], value[first]
    a, b = queries["label"][q], members["label"][m]
    order = np.lexsort((members["row"][m], -value, b, a))
    q, m, a, b = q[order], m[order], a[order], b[order]
    pair = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))]) if len(a) else np.zeros(0, np.int64)
    second = _rank(pair) < most
    return q[second], m[second], not (first.all() and second.all())


def _rank(group: np.ndarray) -> np.ndarray:
    """Place of each element in its run."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    return np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))


def _meet(most: int, similar: float, long: bool):
    """(key, i, j, query, row, label, sketch), sorted -> candidate pairs a, b, and the keys of which pairs are left."""
    width = LONG // 64 if long else BANDS * BAND_ROWS
    kind = np.dtype([("row", np.int64), ("label", np.int64), ("sketch", np.uint64 if long else np.uint8, width)])
    least = LONG - most_differing(similar) if long else (similar - SLACK) * width

    def flush(held: list[pa.RecordBatch], out: list[list]) -> None:
        rows = np.zeros(sum(b.num_rows for b in held), kind)
        for name in ("row", "label"):
            rows[name] = np.concatenate([b.column(name).to_numpy() for b in held])
        rows["sketch"] = np.frombuffer(b"".join([x for b in held for x in b.column("sketch").to_pylist()]), kind["sketch"].base).reshape(len(rows), -1)
        asks = np.concatenate([b.column("query").to_numpy(zero_copy_only=False) for b in held])
        queries, members = rows[asks], rows[~asks]
        q, m, more = best_pairs(queries, members, most, least)
        for values, found in zip(out, (queries["row"][q].tolist(), members["row"][m].tolist(), [held[0].column("key")[0].as_py()] * (len(q) + more)), strict=True):
            values.extend(found + [None] * (len(q) + more - len(found)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, out = None, [], [[], [], []]
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")])
            cuts = [0, *(np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                here = tuple(group[:, a].tolist())
                if held and here != at:
                    flush(held, out)
                    held = []
                at = here
                held.append(batch.slice(a, b - a))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b", "key"])
            out = [[], [], []]
        if held:
            flush(held, out)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b", "key"])

    return run


def _alike(shingle: int, least: float):
    """(a, part, b, text), sorted, a's own text first (b null) -> the pairs a, b that are similar enough. One set is held, another at hand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for a, b, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("text"), strict=True):
                values = shingles(text.as_py(), shingle)
                if b is None:
                    own = values
                elif similarity(own, values) >= least:
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose texts (row, text) are similar enough. Only texts that a pair names are shuffled, a's once for each EDGES of its pairs."""
    spark = pairs.sparkSession
    needed = pairs.select(F.col("a").alias("row")).distinct().union(pairs.select("b").distinct()).select(F.xxhash64("row").alias("key"))
    named = texts.where(may_have(spark, needed)(F.xxhash64("row")))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / EDGES).alias("parts"))
    dealt = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b")
    own = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).join(named.withColumnRenamed("row", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    other = dealt.join(named.withColumnRenamed("row", "b"), "b").select("a", "part", "b", "text")
    rows = own.unionByName(other).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    with batch_bytes(spark, BATCH_BYTES):
        return materialise(rows.mapInArrow(_alike(shingle, least), "a bigint, b bigint"), "alike")


def joined(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """labels (node, label; a node that isn't there is its own group) after edges a, b joined their groups."""
    if labels is None:
        return components(edges)
    known = edges
    for c in "ab":
        known = known.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}")), c, "left").withColumn(f"_{c}", F.coalesce(f"_{c}", c))
    up = components(known.select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b").distinct())
    moved = labels.join(up.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return materialise(moved.unionByName(up.join(labels, "node", "left_anti").select("node", "label")), "groups")


def _lengthened(met: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """met with long sketches, made from the texts of its rows alone."""

    @F.pandas_udf(T.BinaryType())
    def sketch(values: pd.Series) -> pd.Series:
        return pd.Series([long_sketch(shingles(x, shingle)) for x in values], dtype=object)

    spark, rows = met.sparkSession, met.select("row").distinct()
    named = texts.where(may_have(spark, rows.select(F.xxhash64("row").alias("key")))(F.xxhash64("row"))).join(rows, "row")
    with batch_bytes(spark, BATCH_BYTES):
        made = materialise(named.repartition("row").select("row", sketch("text").alias("sketch")), "long-sketches")
    return materialise(met.select("key", "row").join(made, "row"), "met")


def _searched(met: DataFrame, labels: DataFrame | None, drawn: int, most: int, similar: float, long: bool) -> tuple[DataFrame, DataFrame]:
    """One round over buckets (key, row, sketch): candidate pairs a, b, and the keys that need another round."""
    labelled = met.withColumn("label", F.col("row")) if labels is None else met.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    groups = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    buckets = groups.groupBy("key").agg(F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("home"), F.max("n").alias("most")).withColumn("rest", F.col("n") - F.col("most")).where("rest > 0")
    buckets = materialise(buckets.select("key", "n", "home", "rest"), "buckets")
    rows = labelled.join(buckets, "key")
    chance = F.pmod(F.xxhash64("row", "key"), F.lit(1 << 20)) < F.lit(float(drawn << 20)) / F.col("rest")
    i, j = F.ceil(F.least(F.col("rest"), F.lit(2 * drawn)) / QUERIES), F.ceil(F.col("n") / MEMBERS)
    spread = F.xxhash64(F.col("row"), F.lit("block"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asks = rows.where((F.col("label") != F.col("home")) & chance).select("key", F.pmod(spread, i).alias("i"), each(j).alias("j"), F.lit(True).alias("query"), "row", "label", "sketch")
    answers = rows.select("key", each(i).alias("i"), F.pmod(spread, j).alias("j"), F.lit(False).alias("query"), "row", "label", "sketch")
    blocks = asks.unionByName(answers).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = materialise(blocks.mapInArrow(_meet(most, similar, long), "a bigint, b bigint, key bigint"), "found")
    again = found.where("a is null").select("key").union(buckets.where(F.col("rest") > drawn).select("key")).distinct()
    return found.where("a is not null").groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.min("a").alias("a")).select("a", (F.col("lo") + F.col("hi") - F.col("a")).alias("b")), again


def keep_one(docs: DataFrame, *, shingle: int = SHINGLE, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, that are first of their group: the smallest id, ids before null, one row where an id repeats.

    A group is what links of similarity least or more connect. Null, empty and blank texts are alike."""
    spark = docs.sparkSession
    prepare(spark)
    row, made = fresh(docs, "row"), fresh(docs, "made")
    tagged = materialise(docs.select("*", F.monotonically_increasing_id().alias(row), _sketch(shingle)(text_col).alias(made)), "tagged")
    sets = materialise(tagged.groupBy(F.col(made)["digest"].alias("digest")).agg(F.min(row).alias("row"), F.min(F.col(made)["sketch"]).alias("sketch"), F.min(F.col(made)["fp"]).alias("fp")), "sets")
    prints = materialise(sets.groupBy("fp").agg(F.min("row").alias("first")), "set-prints")
    alike = spread_join(sets.select("row", "fp"), prints, "fp", "row").where("row <> first").select(F.col("first").alias("a"), F.col("row").alias("b"))
    near = links(prints).join(prints.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(prints.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    # a link leads from a member to the first of its group, which may have many: that is a
    by_print = alike.unionByName(near.select(F.col("y").alias("a"), F.col("x").alias("b")))
    texts = tagged.select(F.col(row).alias("row"), F.col(text_col).alias("text"))
    tested = materialise(by_print, "tested")
    labels = joined(None, verified(tested, texts, shingle, least))
    banded = sets.select("row", "sketch").mapInArrow(_bands, "key bigint, row bigint, sketch binary")
    live = banded.groupBy("key").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo <> hi").select("key")
    met, drawn, most, turn = materialise(banded.join(live, "key"), "met"), DRAWN, 1, 0
    while True:
        pairs, again = _searched(met, labels, drawn, most, least, turn >= SHORT_ROUNDS)
        seen = tested.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        new = materialise(pairs.withColumns({"lo": F.least("a", "b"), "hi": F.greatest("a", "b")}).join(seen, ["lo", "hi"], "left_anti").select("a", "b"), "tested")
        edges = verified(new, texts, shingle, least)
        if edges.limit(1).count():
            labels = joined(labels, edges)
        rest = materialise(met.join(again, "key", "left_semi"), "met")
        discard(met)
        met, tested, drawn, most, turn = rest, tested.unionByName(new), drawn * GROWTH, most * GROWTH, turn + 1
        if not met.limit(1).count():
            break
        if turn == SHORT_ROUNDS:
            rest = _lengthened(met, texts, shingle)
            discard(met)
            met = rest
    discard(met)
    group = sets.join(labels.withColumnRenamed("node", "row"), "row", "left").select("digest", F.coalesce("label", "row").alias("label"))
    by_row = tagged.select(F.col(id_col).cast("long").alias("doc_id"), F.col(row).alias("row"), F.col(made)["digest"].alias("digest"))
    by_row = spread_join(by_row, group, "digest", "row")
    first = by_row.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("first")).select(F.col("first.row").alias(row))
    return tagged.join(first, row, "left_semi").select(*docs.columns)
