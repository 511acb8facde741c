"""Streaming queries over the events table; files of days land out of order and overlap."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import Tables, with_tables
from ..plans.buckets import BucketTable
from ..plans.stages import shared_folder
from ..streaming.ingest import drop_repeats, read_landing, upsert_available
from ..streaming.stateful import open_documents, series_high_stream


def _folder(spark: SparkSession) -> str:
    """A new folder among those that all executors share."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _land(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Events by day; day 3 lands twice."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("day", F.dayofmonth("ts"))
    again = events.where("day = 3")
    events.unionByName(again).drop("day").repartition(6, "event_id").write.parquet(f"{folder}/landing")
    return events


def available_now_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user, upserted batch by batch."""
    folder = _folder(spark)
    events = _land(spark, sf_dir, folder)
    stream = read_landing(spark, f"{folder}/landing", events.drop("day").schema, max_files=3)
    table = BucketTable(spark, f"{folder}/table", ["user_id"])
    upsert_available(stream, table, f"{folder}/checkpoint", ["ts", "event_id"])
    return table.read().select("user_id", "event_id", "event_type", "value")


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events once each, though some land twice."""
    folder = _folder(spark)
    events = _land(spark, sf_dir, folder)
    stream = drop_repeats(read_landing(spark, f"{folder}/landing", events.drop("day").schema), ["event_id"], "ts", "60 days")
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id", "event_type")


def series_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The high-water number of each series after three landings, with a restart of the stream between them."""
    folder, numbers = _folder(spark), Tables(spark, sf_dir).invoice_header.select("no", "k")
    table = BucketTable(spark, f"{folder}/high", ["series"], 4)
    out = None
    for part in range(3):
        numbers.where(F.col("k") % 3 == part).select("no").write.mode("append").parquet(f"{folder}/landing")
        stream = read_landing(spark, f"{folder}/landing", numbers.select("no").schema)
        out = series_high_stream(stream, table, f"{folder}/checkpoint", "no")
    return out.select("series", "high")


TURN = "1998-01-01"


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a line past the lookback, from two streams that land in two halves."""
    folder, t = _folder(spark), Tables(spark, sf_dir, written=False)
    heads = t.invoice_header.select("no", F.col("posting_date").cast("timestamp").alias("at"), "k")
    lines = t.invoice_line.join(heads.where("k % 10 <> 3").select(F.col("no").alias("document_no"), "at"), "document_no").select("document_no", F.col("at").alias("line_at"))
    for before in (True, False):
        heads.where((F.col("at") < F.lit(TURN)) == before).select("no", "at").write.mode("append").parquet(f"{folder}/heads")
        lines.where((F.col("line_at") < F.lit(TURN)) == before).write.mode("append").parquet(f"{folder}/lines")
        streams = [read_landing(spark, f"{folder}/{name}", df.schema) for name, df in (("heads", heads.select("no", "at")), ("lines", lines))]
        found = open_documents(*streams, "no", "document_no", "at", "line_at")
        found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("no string, at timestamp").parquet(f"{folder}/out")


QUERIES = {"str_available_now_upsert": available_now_upsert, "str_dedup": dedup, "str_series_high": series_water, "str_gaps": gaps}
ORACLE_SQL = {
    "str_available_now_upsert": "select cast(user_id as varchar) as user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type, arg_max(value, (ts, event_id)) as value from events group by 1",
    "str_dedup": "select event_id, user_id, event_type from events",
    "str_series_high": with_tables("select split_part(no, '-', 1) as series, max(no) as high from invoice_header group by 1"),
    "str_gaps": with_tables("""select no, cast(posting_date as timestamp) as at from invoice_header left join (select distinct document_no from invoice_line where k % 10 <> 3) on document_no = no
        where document_no is null and posting_date + interval 30 day < (select least(max(h.posting_date), max(h.posting_date) filter (h.k % 10 <> 3 and l.document_no is not null)) from invoice_header h left join invoice_line l on l.document_no = h.no)"""),
}
