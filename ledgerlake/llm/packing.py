"""Best-fit packing of token pieces into sequences of a fixed capacity by exact-complement hashing.

Packing needs only how many pieces there are of each length, at most `capacity` numbers whatever the corpus. From that table the driver
plans recipes (lengths in one sequence, and how many such sequences); executors turn a piece's rank among those of its length into a place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, prepare, slices
from .tokens import encoder, tokenizer_path

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"


def plan_recipes(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """[(lengths in the order of their places, number of sequences)].

    For the longest length left, a single length, a pair and then a triple that fill the gap exactly are looked up; each found combination
    is used as often as its lengths last. What then remains is packed best fit: the longest length that still fits, again in bulk.
    Every step uses up a length, so there are at most 2 * capacity recipes.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    recipes = []

    def use(lengths: list[int]) -> None:
        need: dict[int, int] = defaultdict(int)
        for n in lengths:
            need[n] += 1
        times = min(left[n] // k for n, k in need.items())
        recipes.append((lengths, times))
        for n, k in need.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]

    def enough(*lengths: int) -> bool:
        return all(left.get(n, 0) >= lengths.count(n) for n in lengths)

    def pair(gap: int, *others: int) -> list[int] | None:
        """Two lengths that sum up to gap, the longest first."""
        for n in have[: bisect_right(have, gap - 1)][::-1]:
            if 2 * n < gap:
                return None
            if enough(n, gap - n, *others):
                return [n, gap - n]
        return None

    for longest in sorted(left, reverse=True):
        while longest in left:
            gap, have = capacity - longest, sorted(left)
            found = [] if gap == 0 else [gap] if enough(gap, longest) else pair(gap, longest)
            if found is None:
                pairs = {a + b for i, a in enumerate(have[: bisect_right(have, gap)]) for b in have[i : bisect_right(have, gap - a)]} if gap <= len(have) ** 2 else None
                for n in have[: bisect_right(have, gap - 2)][::-1]:
                    if (pairs is None or gap - n in pairs) and (rest := pair(gap - n, n, longest)):
                        found = [n, *rest]
                        break
            if found is None:
                break
            use([longest, *found])
    while left:
        lengths, gap, spare = [], capacity, dict(left)
        have = sorted(spare)
        while (k := bisect_right(have, gap)) > 0:
            n = have[k - 1]
            lengths.append(n)
            gap -= n
            spare[n] -= 1
            if not spare[n]:
                have.pop(k - 1)
        use(lengths)
    return recipes


def place_table(recipes: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Of each length: first rank of each run of places, sequences of that run (first and number), offset in them; a rank r of run i lies
    in sequence first_i + r - rank_i."""
    rows: dict[int, list] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first = 0
    for lengths, times in recipes:
        at = 0
        for n in lengths:
            rows[n].append((used[n], first, at))
            used[n] += times
            at += n
        first += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for n, r in rows.items()}


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, code, seen = TaskContext.get().partitionId(), encoder(path), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            docs, pieces, starts, lengths, crcs, ranks = [], [], [], [], [], []
            for doc, ids in zip(batch.column(0).to_pylist(), code.all_ids(batch.column(1).to_pylist()), strict=True):
                ids = np.append(ids, END_ID).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    piece = ids[start : start + capacity]
                    docs.append(doc)
                    pieces.append(k)
                    starts.append(start)
                    lengths.append(len(piece))
                    crcs.append(zlib.crc32(piece.tobytes()))
                    ranks.append(int(seen[len(piece)]))
                    seen[len(piece)] += 1
            cols = [pa.array(docs, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array([part] * len(docs), pa.int32()), pa.array(ranks, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[x.split(" ")[0] for x in PIECES.split(", ")])

    return run


def _place(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = table.value
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                rank, first, off = places[int(n)]
                i = np.searchsorted(rank, ranks[at], "right") - 1
                sequence[at], offset[at] = first[i] + ranks[at] - rank[i], off[i]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(5)], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def cut_pieces(docs: DataFrame, *, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most capacity ids of every document, each with its rank among the pieces of its length in its partition (written table)."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialise(texts.mapInArrow(_cut(tokenizer or tokenizer_path(), capacity), PIECES), "pieces")


def pack_sequences(docs: DataFrame, *, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Null text is an empty one, which has the end id alone. Repeated rows and null ids are packed like any other. Sequences are gapless from
    offset 0; their numbers are dense from 0. An empty table gives no rows.
    """
    pieces = cut_pieces(docs, capacity=capacity, tokenizer=tokenizer, id_col=id_col, text_col=text_col)
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("length", "part", "base")
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    table = docs.sparkSession.sparkContext.broadcast(place_table(plan_recipes(counts, capacity)))  # at most 2 * capacity recipes
    ranked = pieces.join(offsets, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(_place(table), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
