"""Benchmark decontamination by greedy string tiling.

Words of a text and of the benchmark items are hashed. Runs of five words are seeds: texts pass a table of bits of the items' seeds and what passes is
joined with them, which bounds how much of an item a text can cover. Pairs that may reach the threshold are tiled: the longest unmarked common runs are
marked, found by running Karp-Rabin hashing, longest first. Tiles may stand in any order, so passages whose sentences were moved are caught. An item of
fewer words than a seed is its own seed and counts where it stands whole.

Equal texts are looked at once: texts and items meet by their digests.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_table, fresh, in_table, materialise, prepare, slices, spread_join, text_digest

SEED_WORDS = 5
COVERAGE = 0.8
BROADCAST_ROWS = 200_000  # contaminated texts (a digest each) that are told to every task when documents are dropped; more are joined

_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_MARKS = re.compile("[ -¿ -⁯　-〿]")
_BASE, _STEP, _MIX = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1, 0xFF51AFD7ED558CCD


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_ahead, _back = _powers(_BASE, 1 << 12), _powers(pow(_BASE, -1, 1 << 64), 1 << 12)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _ahead, _back
    if len(_ahead) < n:
        size = 1 << (n - 1).bit_length()
        _ahead, _back = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _ahead[:n], _back[:n]


def normal(text: str | None) -> bytes:
    """Lower-cased words between single spaces or more: ASCII and common Unicode punctuation separate words."""
    return _MARKS.sub(" ", (text or "").lower()).encode("utf-8", "replace").translate(_SPACES)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, number of the text it is in), for all texts at once."""
    raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    edge = np.diff((raw != 32).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ahead, back = _tables(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw.astype(np.uint64) * ahead[:-1])])
    words = (sums[ends] - sums[starts]) * back[starts]
    words ^= words >> np.uint64(29)
    words *= np.uint64(_MIX)
    bounds = np.cumsum([1 + len(t) for t in texts])
    return words ^ (words >> np.uint64(32)), np.searchsorted(bounds, starts, "left")


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(_STEP) + words[k : len(words) - n + 1 + k]
    out ^= out >> np.uint64(31)
    return out * np.uint64(_MIX)


def tile(item: np.ndarray, text: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: (place in item, place in text, length), no shorter than least, none overlapping."""
    free_i, free_t, tiles = np.ones(len(item), bool), np.ones(len(text), bool), []
    size = max(least, min(20, len(item)))

    def runs(free: np.ndarray) -> np.ndarray:
        """Places from which `size` words are unmarked."""
        total = np.concatenate([[0], np.cumsum(free)])
        return np.flatnonzero(total[size:] - total[:-size] == size) if len(free) >= size else np.zeros(0, np.int64)

    def matches(p: int, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the places t those that match from p on and can't begin earlier, with their lengths; all at once, word by word."""
        if p and free_i[p - 1]:
            before = np.maximum(t - 1, 0)
            t = t[(t == 0) | (text[before] != item[p - 1]) | ~free_t[before]]
        for j in range(size):
            t = t[text[t + j] == item[p + j]]
        length, live = np.full(len(t), size, np.int64), np.arange(len(t))
        for k in range(size, len(item) - p):
            at = t[live] + k
            inside = at < len(text)
            live, at = live[inside], at[inside]
            live = live[(text[at] == item[p + k]) & free_t[at]] if free_i[p + k] else live[:0]
            if not len(live):
                break
            length[live] += 1
        return t, length

    while True:
        longest, found = 0, []
        hashes, wanted, places = grams(text, size), grams(item, size), runs(free_t)
        places = places[np.isin(hashes[places], wanted)] if len(places) else places
        places = places[np.argsort(hashes[places], kind="stable")] if len(places) else places
        keys = hashes[places] if len(places) else hashes[:0]
        for p in runs(free_i).tolist():
            t, length = matches(p, places[np.searchsorted(keys, wanted[p]) : np.searchsorted(keys, wanted[p], "right")])
            if len(t):
                found.append((np.full(len(t), p), t, length))
                longest = max(longest, int(length.max()))
            if longest > 2 * size:
                break
        if longest > 2 * size:
            size = longest
            continue
        heap = [(-k, p, t) for x in found for p, t, k in zip(*(y.tolist() for y in x), strict=True)]
        heapq.heapify(heap)
        while heap:  # a match cut by a tile comes again with each part that is left of it
            k, p, t = heapq.heappop(heap)
            both = free_i[p : p - k] & free_t[t : t - k]
            if both.all():
                tiles.append((p, t, -k))
                free_i[p : p - k] = free_t[t : t - k] = False
            elif both.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[False], both, [False]]).astype(np.int8)))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    if b - a >= size:
                        heapq.heappush(heap, (a - b, p + a, t + a))
        if size == least:
            return tiles
        size = max(least, size // 2)


def seeds_of(words: np.ndarray) -> np.ndarray:
    """The seeds of an item: its runs of five words, or all its words where it has fewer."""
    return grams(words, SEED_WORDS) if len(words) >= SEED_WORDS else short_seed(grams(words, len(words)), len(words))


def short_seed(hashes: np.ndarray, n: int) -> np.ndarray:
    return hashes ^ np.uint64(n * _MIX & (1 << 64) - 1)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, words, seeds) of each item that has a word."""
    for batch in batches:
        made = [(d, hash_words([normal(t)])[0]) for d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        made = [(d, w) for d, w in made if len(w)]
        seeds = pa.array([seeds_of(w).view(np.int64) for _, w in made], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in made], pa.binary()), pa.array([w.tobytes() for _, w in made], pa.binary()), seeds], names=["item", "words", "seeds"])


def _hits(table, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(digest, words, seeds) of the texts with a seed that an item may have."""
        for batch in slices(batches, "text", 2 << 20):
            texts = batch.column(0).to_pylist()
            words, owner = hash_words([normal(t) for t in texts])
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for n in [SEED_WORDS, *lengths]:
                hashes = grams(words, n)
                hashes = hashes if n == SEED_WORDS else short_seed(hashes, n)
                near = np.flatnonzero(in_table(table.value, hashes))
                near = near[in_table(table.value, hashes[near] >> np.uint64(32))]
                near = near[owner[near] == owner[near + n - 1]] if len(near) else near
                found.append((owner[near], hashes[near]))
            who, seeds = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            rows = [(hashlib.sha256(texts[i].encode()).digest()[:16], words[bounds[i] : bounds[i + 1]].tobytes(), np.unique(seeds[who == i]).view(np.int64)) for i in np.unique(who).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["digest", "words", "seeds"])

    return run


def _tiles(coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(digest, item, coverage) of the pairs whose tiles cover enough of the item."""
        for batch in batches:
            rows = []
            for digest, item, text_words, item_words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text, own = (np.frombuffer(x, np.uint64) for x in (text_words, item_words))
                share = 1.0 if len(own) < SEED_WORDS else sum(k for _, _, k in tile(own, text)) / len(own)
                if share >= coverage:
                    rows.append((digest, item, share))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.float64()))], names=["digest", "item", "coverage"])

    return run


def match_texts(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """digest, item_ids, coverage of each text that covers an item: the items' ids, and the largest share. Null texts and items without a word match
    nothing; items of one text are one item with several ids."""
    spark = docs.sparkSession
    prepare(spark)
    named = benchmark.select(text_digest(item_text).alias("item"), F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    items = materialise(named.groupBy("item").agg(F.first("text").alias("text")).mapInArrow(_items, "item binary, words binary, seeds array<bigint>"), "items")
    seeds = items.select("item", (F.octet_length("words") / 8).cast("int").alias("n"), F.posexplode("seeds").alias("place", "seed"))
    lengths = [r["n"] for r in seeds.where(F.col("n") < SEED_WORDS).select("n").distinct().collect()]  # below five
    keys = seeds.select(F.col("seed").alias("key")).distinct()
    table = spark.sparkContext.broadcast(bit_table(keys.union(keys.select(F.shiftrightunsigned("key", 32))), per_key=512))  # a seed passes by both its halves
    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    hits = materialise(texts.mapInArrow(_hits(table, lengths), "digest binary, words binary, seeds array<bigint>").dropDuplicates(["digest"]), "hits")
    met = spread_join(hits.select("digest", F.explode("seeds").alias("seed")), seeds, "seed", "digest").where("item is not null")
    places = F.array_distinct(F.flatten(F.transform(F.collect_set("place"), lambda p: F.sequence(p, p + SEED_WORDS - 1))))
    pairs = met.groupBy("digest", "item").agg(F.first("n").alias("n"), F.size(places).alias("reach")).where((F.col("n") < SEED_WORDS) | (F.col("reach") >= coverage * F.col("n")))
    whole = pairs.select("digest", "item").join(hits.select("digest", F.col("words").alias("text_words")), "digest").join(items.select("item", F.col("words").alias("item_words")), "item")
    tiled = whole.select("digest", "item", "text_words", "item_words").mapInArrow(_tiles(coverage), "digest binary, item binary, coverage double")
    ids = tiled.join(named.select("item", "item_id").distinct(), "item")
    return materialise(ids.groupBy("digest").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage")), "contaminated")


def find_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """doc_id, contaminated, item_ids (sorted), coverage (the largest, 0 without a match) of every row.

    Null and empty texts are clean; repeated rows and null ids keep their rows; without benchmark items every row is clean; an item whose id is null
    contaminates without being named."""
    found = match_texts(docs, benchmark, text_col=text_col, coverage=coverage)
    rows = spread_join(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest")), found, "digest", "doc_id")
    return rows.select("doc_id", F.col("coverage").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", coverage: float = COVERAGE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of docs, all columns as they are, that cover no benchmark item. Rows with a null text stay."""
    found = match_texts(docs, benchmark, text_col=text_col, coverage=coverage)
    digest = fresh(docs, "digest")
    keyed, gone = docs.withColumn(digest, text_digest(text_col)), found.select(F.col("digest").alias(digest))
    if gone.count() <= broadcast_rows:
        return keyed.join(F.broadcast(gone), digest, "left_anti").select(*docs.columns)
    mark = fresh(docs, "gone")
    return spread_join(keyed, gone.withColumn(mark, F.lit(True)), digest, digest).where(F.col(mark).isNull()).select(*docs.columns)
