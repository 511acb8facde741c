"""Helpers shared by the llm operators: worker import path, shared folder, tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package where the folder is visible to them (otherwise ship it with --py-files)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, have) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset and all runs in this process (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or _own_dir()).rstrip("/")


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="spark-shared-")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a materialised table that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one column holds about max_bytes at most (a single longer value stands alone)."""
    for batch in batches:
        n, at = batch.num_rows, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        while at < n:
            end, total = at, 0
            while end < n and (end == at or total + sizes[end] <= max_bytes):
                total += int(sizes[end])
                end += 1
            yield batch.slice(at, end - at)
            at = end


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


PIECES, LEAST_PIECE = 2000, 64


def spread_join(left: DataFrame, right: DataFrame, key: str, by: str, pieces: int = PIECES) -> DataFrame:
    """left.join(right, key, "left") in which no key brings more than about one in `pieces` of left's rows to a task.

    A key with more rows (there are `pieces` of them at most, so their table is small) is dealt over several salts by a hash of the column `by`, and
    its rows of right stand once under each salt. Rows with a null key join nothing and stay out of the shuffle."""
    spark, known = left.sparkSession, left.where(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count("*").alias("n"))
    limit = max(LEAST_PIECE, (counts.agg(F.sum("n")).first()[0] or 0) // pieces)
    hot = [(r[key], -(-r["n"] // limit)) for r in counts.where(F.col("n") > limit).collect()]
    salts, salt = (next(c for c in (f"{name}_{k}" for k in range(len(left.columns) + len(right.columns) + 1)) if c not in {x.lower() for x in (*left.columns, *right.columns)}) for name in ("salts", "salt"))
    table = F.broadcast(spark.createDataFrame(hot, f"`{key}` {left.schema[key].dataType.simpleString()}, `{salts}` bigint"))
    dealt = known.join(table, key, "left").withColumn(salt, F.pmod(F.xxhash64(by), F.coalesce(F.col(salts), F.lit(1)))).drop(salts)
    copies = right.where(F.col(key).isNotNull()).join(table, key, "left").withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(salts), F.lit(1)) - 1))).drop(salts)
    return dealt.join(copies, [key, salt], "left").drop(salt).unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


MAX_BITS = 28


def bit_table(keys: DataFrame, per_key: int = 8, max_bits: int = MAX_BITS) -> tuple[np.ndarray, int]:
    """A table of bits, one set for the low bits of each `key` (a long): per_key bits a key, 2^max_bits (32 MB) at most. What it passes is looked up
    exactly afterwards, so more keys than it holds cost more rows there, not results."""
    log2 = min(max_bits, max(12, (per_key * keys.count()).bit_length()))
    slot = F.col("key").bitwiseAND(F.lit((1 << log2) - 1))
    packed = keys.groupBy(F.shiftrightunsigned(slot, 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(key & 63 as int)))").alias("bits")).toArrow()
    words = np.zeros(1 << (log2 - 6), np.uint64)
    words[packed.column("word").to_numpy()] = packed.column("bits").to_numpy().view(np.uint64)
    return words, log2


def in_table(table: tuple[np.ndarray, int], key: np.ndarray) -> np.ndarray:
    """Which keys have their bit set."""
    words, log2 = table
    slot = key & np.uint64((1 << log2) - 1)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def may_have(spark: SparkSession, keys: DataFrame):
    """A test whether a long may be among `key` of keys, by a broadcast table of bits; what it passes by chance an exact join must drop."""
    table = spark.sparkContext.broadcast(bit_table(keys))

    @F.pandas_udf("boolean")
    def test(key: pd.Series) -> pd.Series:
        return pd.Series(in_table(table.value, key.to_numpy().view(np.uint64)))

    return test


@contextmanager
def batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches of `most` bytes for the jobs run inside, so that long values don't come by the thousand."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def text_digest(text: str) -> Column:
    """The first 16 bytes of a text's SHA-256: equal texts share it."""
    return F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16)


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """df, materialised, with `at` (place in its group by order, nulls first, from 0) and `size` (rows of the group).

    No group meets in a task: the rows are range-partitioned by group, order and a hash that spreads full ties (whose places are interchangeable), then
    counts of each range and group, which are few, give the place at which a range begins."""
    rows = df.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*group, *order, "_spread").sortWithinPartitions(*group, *order, "_spread").drop("_spread")
    rows = materialise(rows.withColumn("_place", F.monotonically_increasing_id()), name).withColumn("_range", F.shiftrightunsigned("_place", 33))
    counts = rows.groupBy("_range", *group).agg(F.min("_place").alias("_low"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", *group, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"), F.sum("_n").over(Window.partitionBy(*group)).alias("size"))
    return rows.join(materialise(starts, f"{name}-starts"), ["_range", *group]).withColumn("at", F.col("_place") + F.col("_shift")).drop("_range", "_place", "_shift")
