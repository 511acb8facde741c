"""Structured Streaming ingest: landed files upserted into a keyed table, one commit a micro-batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import last_wins
from ..plans.buckets import BucketTable
from ..plans.ingest_run import Lake


def read_landing(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def upsert_available(stream: DataFrame, table: BucketTable, checkpoint: str, order: list[str], keep: int = 3) -> int:
    """Merge everything that has landed into table and stop; returns the newest version's number, -1 without any.

    A batch rewrites the buckets that it touches and commits under its own number and checkpoint, so a repeated batch commits once. Late rows merge
    like any other; of rows with one key the last by `order` stands, also against the stored row. Columns that come new are added. The `keep` newest
    versions stay readable."""

    def write(batch: DataFrame, number: int) -> None:
        table.merge(last_wins(batch, table.key, order), F.current_timestamp(), tag=f"{checkpoint}#{number}", newer=order)
        table.retain(keep)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return max(table.versions(), default=-1)


def upsert_with_state(lake: Lake, feed: str, stream: DataFrame, table: BucketTable, checkpoint: str, order: list[str], now: datetime) -> str:
    """upsert_available with the feed's progress in the lake's state: rows of the newest version after success, the error after a failure (what the
    batches before it have merged stays, and the next call goes on from the checkpoint). Returns the status."""
    state = lake.save_state(lake.state(feed), now, status="in_progress", records_processed=None, records_failed=None, last_error=None)
    try:
        version = upsert_available(stream, table, checkpoint, order)
        rows = table.read().count() if version >= 0 else 0
        lake.save_state(state, now, status="success", last_sync_at=now, records_processed=rows, records_failed=0)
        return "success"
    except Exception as e:  # the boundary of a run: the state keeps what went wrong
        lake.save_state(state, now, status="failed", last_error=f"{type(e).__name__}: {e}"[:2000])
        return "failed"


def drop_repeats(stream: DataFrame, key: list[str], time_field: str, delay: str = "2 days") -> DataFrame:
    """Rows whose key has not been seen within the delay: overlapping pulls send a row twice."""
    return stream.withWatermark(time_field, delay).dropDuplicatesWithinWatermark(key)
