"""Keyed state over landed rows: the high-water number of each series, and documents that stay without a line."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.strategies import series_of
from ..plans.buckets import BucketTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class HighWater(StatefulProcessor):
    """One value a series: the largest number seen. A row comes out when it rises."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._high = handle.getValueState("high", "high string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - the API's names
        stored = self._high.get()[0] if self._high.exists() else None
        numbers = [x for x in (part["number"].dropna().max() for part in rows) if isinstance(x, str)]
        high = max([*numbers, *([stored] if stored is not None else [])], default=None)
        if high is not None and high != stored:
            self._high.update((high,))
            yield pd.DataFrame({"series": [key[0]], "high": [high]})

    def close(self) -> None:
        pass


def series_high_stream(numbers: DataFrame, table: BucketTable, checkpoint: str, field: str, sep: str = "-") -> DataFrame | None:
    """Bring table (series, high; keyed by series) up to what has landed, and read it: the high-water number of each series, as series_high gives it.

    The state is a value a series, so a call reads new rows only; after a restart it goes on from the checkpoint. A repeated batch commits once."""
    spark = numbers.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = numbers.where(F.coalesce(F.col(field), F.lit("")) != "").select(series_of(field, sep).alias("series"), F.col(field).alias("number")).where("series <> ''")
    high = rows.groupBy("series").transformWithStateInPandas(HighWater(), "series string, high string", "Update", "None")

    def write(batch: DataFrame, number: int) -> None:
        table.merge(batch, F.current_timestamp(), tag=f"{checkpoint}#{number}")
        table.retain()

    high.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return table.read()


def open_documents(documents: DataFrame, lines: DataFrame, key: str, line_key: str, time: str, line_time: str, lookback: str = "30 days", delay: str = "0 days") -> DataFrame:
    """Documents that no line has come for within the lookback, as the watermark passes it: a left outer join of two streams.

    documents: key and time; lines: line_key and line_time, which is not before its document's time."""
    left = documents.select(key, time).withWatermark(time, delay)
    right = lines.select(F.col(line_key).alias("_line_of"), F.col(line_time).alias("_line_at")).withWatermark("_line_at", delay)
    near = (F.col(key) == F.col("_line_of")) & (F.col("_line_at") >= F.col(time)) & (F.col("_line_at") <= F.col(time) + F.expr(f"interval {lookback}"))
    return left.join(right, near, "left_outer").where("_line_of is null").select(key, time)
