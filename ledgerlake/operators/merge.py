"""Keyed merge of a batch into a stored table, without a table format: a full outer join, and a new version of the table.

Keys are text. Unchanged rows keep their `_synced_at`, columns that a batch does not have keep their stored values, keyless rows leave by a side door.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYNCED = "_synced_at"


def text_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key columns as text, whatever they arrived as."""
    return df.withColumns({k: F.col(k).cast("string") for k in key})


def keyless(key: list[str], allow_empty: tuple[str, ...] = ()) -> Column:
    """True where a key part is null, or blank without leave."""
    parts = [F.col(k).isNull() | (F.lit(k not in allow_empty) & (F.trim(F.col(k).cast("string")) == "")) for k in key]
    return reduce(lambda a, b: a | b, parts)


def changes(merged: DataFrame) -> DataFrame:
    """One row: how many rows of a merge were inserted, updated and kept."""
    return merged.agg(*[F.count_if(F.col("_action") == a).alias(name) for a, name in (("insert", "inserted"), ("update", "updated"), ("keep", "kept"))])


def split_invalid(df: DataFrame, key: list[str], allow_empty: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows for quarantine with their reason)."""
    bad = keyless(key, allow_empty)
    return df.where(~bad), df.where(bad).withColumn("reason", F.lit("missing or blank key"))


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that a batch has more than once, with how often."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def rekey_check(df: DataFrame, new_key: list[str]) -> int:
    """Number of keys that would stand twice under new_key; a re-key goes ahead only at 0."""
    return duplicate_keys(text_keys(df, new_key), new_key).count()


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows with one key the last in `order`: a later page overrides an earlier one."""
    newest = Window.partitionBy(*key).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")


def resolve_duplicates(df: DataFrame, key: list[str], policy: str = "error", order: list[str] | None = None) -> DataFrame:
    """policy `error` refuses a batch with a repeated key, `last` keeps the last by `order`."""
    if policy == "last":
        return last_wins(df, key, order or [])
    if policy != "error":
        raise ValueError(f"unknown policy {policy!r}")
    if duplicate_keys(df, key).limit(1).count():
        raise ValueError(f"the batch has rows with the same key ({', '.join(key)})")
    return df


def merge(stored: DataFrame, batch: DataFrame, key: list[str], now: Column, preserve: tuple[str, ...] = ()) -> DataFrame:
    """The next version of stored with `_action` (insert, update or keep).

    Columns only in batch are added, columns only in stored stay as they are; a null in a column that the batch has is written. `preserve` columns are set
    on insert and never updated. A row counts as changed when a payload column differs, nulls being equal; then `_synced_at` becomes now."""
    stored, batch = text_keys(stored, key), text_keys(batch, key)
    payload = [c for c in batch.columns if c not in (*key, SYNCED)]
    columns = [c for c in dict.fromkeys([*stored.columns, *payload]) if c != SYNCED]
    s = stored.select(*[F.col(c).alias(f"s_{c}") for c in stored.columns], F.lit(True).alias("s_"))
    b = batch.select(*[F.col(c).alias(f"b_{c}") for c in [*key, *payload]], F.lit(True).alias("b_"))
    joined = s.join(b, [F.col(f"s_{k}") == F.col(f"b_{k}") for k in key], "full_outer")
    held, came = F.col("s_").isNotNull(), F.col("b_").isNotNull()
    watched = [c for c in payload if c not in preserve]
    old = F.struct(*[F.col(f"s_{c}") if c in stored.columns else F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in watched] or [F.lit(1)])
    new = F.struct(*[F.col(f"b_{c}") for c in watched] or [F.lit(1)])
    action = F.when(~held, "insert").when(came & ~old.eqNullSafe(new), "update").otherwise("keep")

    def value(c: str) -> Column:
        if c in key:
            return F.coalesce(f"s_{c}", f"b_{c}")
        if c not in payload:
            return F.col(f"s_{c}")
        mine = F.col(f"s_{c}") if c in stored.columns else F.lit(None)
        return F.when(~held, F.col(f"b_{c}")).when(came & F.lit(c not in preserve), F.col(f"b_{c}")).otherwise(mine)

    synced = F.col(f"s_{SYNCED}") if SYNCED in stored.columns else F.lit(None).cast("timestamp")
    return joined.withColumn("_action", action).select(*[value(c).alias(c) for c in columns], F.when(F.col("_action") == "keep", synced).otherwise(now).alias(SYNCED), "_action")


def merge_into(stored_path: str, batch: DataFrame, key: list[str], new_path: str, now: Column | None = None) -> dict[str, int]:
    """Write the next version beside the stored one (readers switch afterwards) and count the actions."""
    spark = batch.sparkSession
    result = merge(spark.read.parquet(stored_path), batch, key, now if now is not None else F.current_timestamp())
    result.write.parquet(new_path)
    return {r["_action"]: r["n"] for r in spark.read.parquet(new_path).groupBy("_action").agg(F.count("*").alias("n")).collect()}
