"""Ledgers that are joined by document and line, stored in buckets of that key so that their joins need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stages import shared_folder

KEY = ("document_no", "line_no")
BUCKETS = 16
ROWS = 500_000


def buckets_of(rows: int) -> int:
    """Buckets for a ledger of so many rows: BUCKETS at least, and no more than ROWS rows in one, since a task sorts a bucket whole."""
    return max(BUCKETS, -(-rows // ROWS))


def store_bucketed(df: DataFrame, name: str, key: tuple[str, ...] = KEY, buckets: int = BUCKETS) -> DataFrame:
    """df as a table bucketed and sorted by key, below the shared folder; its bucketing is known to the session's catalog."""
    spark, at = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    # one task a bucket writes one file, which a join then reads in order
    df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).option("path", f"{shared_folder(spark)}/{at}").saveAsTable(at)
    return spark.table(at)


def line_totals(lines: DataFrame, taxes: DataFrame, costs: DataFrame) -> DataFrame:
    """Each posted line with the sums of its tax and cost entries. Tables stored by store_bucketed meet without an exchange."""
    tax = taxes.groupBy(*KEY).agg(F.sum("amount").alias("tax"), F.count("*").alias("tax_entries"))
    cost = costs.groupBy(*KEY).agg(F.sum("cost").alias("cost"))
    return lines.join(tax, list(KEY), "left").join(cost, list(KEY), "left").withColumn("tax_entries", F.coalesce("tax_entries", F.lit(0)))
