"""Ingest runs: a service's rows from its source into a versioned table, with the state that says where the next run goes on.

A run chooses what to pull (backfill windows, an incremental slice, a whole refresh), normalises it, sets invalid and unfitting rows aside, merges the
rest into the table, and appends its counters and its new state. Tables stand in key-hash buckets, so a merge rewrites what its batch touches.

A backfill lands its windows before it merges them: many windows in one job, each with a part and a mark of its own. When such a job fails, its windows are
pulled one by one up to the one that fails; what has landed is merged, and the next run goes on behind the last whole window.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize as n
from ..operators import merge as m
from ..operators import strategies as s
from .buckets import BucketTable
from .stages import children, create_file, discard, remove, stage

STATE = "service_name string, step bigint, status string, last_sync_at timestamp, history_through date, records_processed bigint, records_failed bigint, last_error string, at timestamp, open_read_at timestamp, resume_from date"
SUMMARY = "service_name string, step bigint, phase string, fetched bigint, inserted bigint, failed bigint, skipped bigint, status string"
KEYS = "table_name string, key_columns string"
SAMPLE_ROWS = 50  # of a source, for a table that is made before its first run
WINDOWS = 24  # of a backfill landed by one job
GAPS = 200  # parents without a row that a run asks for again, the highest first; the next run goes on


@dataclass(frozen=True)
class Service:
    """What is pulled and how. order: columns that say which of equal keys comes last.

    strategy: date, full_refresh, or series, which pulls the rows past the highest stored number of each series (`series_field`) that the table `parent`
    names in `parent_field`, and then those of recent parents (`parent_date`) that have none. open_field: a flag of rows that may still change; every
    `open_hours` those open at the source or held open here are read again."""

    name: str
    table: str
    key: tuple[str, ...]
    order: tuple[str, ...]
    strategy: str = "date"
    history_field: str | None = None
    incremental_field: str | None = None
    granularity: str = "monthly"
    start: date = date(2000, 1, 1)
    lookback_days: int = 7
    include_undated: bool = False
    extra_fields: tuple[str, ...] = ()
    allow_empty: tuple[str, ...] = ()
    quarantine_invalid: bool = True
    static_filter: str | None = None
    series_field: str | None = None
    parent: str | None = None
    parent_field: str | None = None
    parent_date: str | None = None
    open_field: str | None = None
    open_hours: int = 24
    keep_raw: bool = False  # the record as it came, as JSON in a column of its own
    json_fields: tuple[str, ...] = ()  # texts of JSON, of which a blank one is none


class Lake:
    """Bucketed tables, and the append-only side tables _state, _summary, _keys, _quarantine and _failed, below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def table(self, name: str, key: tuple[str, ...] | list[str] = ()) -> BucketTable:
        return BucketTable(self.spark, f"{self.root}/{name}", list(key))

    def version(self, table: str) -> int:
        """The newest version of a table, -1 without one."""
        return max(self.table(table).versions(), default=-1)

    def read(self, table: str) -> DataFrame | None:
        return self.table(table).read()

    def write(self, table: str, df: DataFrame, key: tuple[str, ...] | list[str]) -> None:
        self.table(table, key).replace(df)

    def append(self, side: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.root}/_{side}")

    def side(self, side: str, schema: str) -> DataFrame:
        there = children(self.spark, f"{self.root}/_{side}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/_{side}") if there else self.spark.createDataFrame([], schema)

    def states(self) -> DataFrame:
        """The last state of each service."""
        rows = self.side("state", STATE)
        return rows.groupBy("service_name").agg(F.max_by(F.struct(*rows.columns[1:]), "step").alias("s")).select("service_name", "s.*")

    def state(self, name: str) -> dict:
        found = self.states().where(F.col("service_name") == name).first()
        return found.asDict() if found else {"service_name": name, "step": 0, "last_sync_at": None, "history_through": None}

    def save_state(self, state: dict, now: datetime, **changes) -> dict:
        """Append the next state row; what isn't changed stays."""
        new = state | {"resume_from": None} | changes | {"step": state["step"] + 1, "at": now}
        names = [f.split(" ")[0] for f in STATE.split(", ")]
        self.append("state", self.spark.createDataFrame([tuple(new.get(k) for k in names)], STATE))
        return new

    def set_aside(self, side: str, table: str, rows: DataFrame, reason: str) -> None:
        row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
        self.append(side, rows.select(F.lit(table).alias("table_name"), F.lit(reason).alias("reason"), row.alias("row")))


SIDE = "table_name string, reason string, row string"


def guard_key(lake: Lake, service: Service) -> bool:
    """Whether the table's key is the service's; a difference is told, since merges go by the service's."""
    kept = lake.side("keys", KEYS).where(F.col("table_name") == service.table).first()
    if kept is None or set(kept["key_columns"].split(",")) == set(service.key):
        return True
    warnings.warn(f"{service.name}: the key of {service.table} is {kept['key_columns']}, the service says {','.join(service.key)}", stacklevel=2)
    return False


def create_table(lake: Lake, service: Service, source: DataFrame, sample_rows: int = SAMPLE_ROWS) -> None:
    """An empty table of the types that a sample of the source needs, before the first run; a table that is there stays."""
    if lake.version(service.table) >= 0:
        return
    sample = n.flatten(source.limit(sample_rows))
    types = {r["column_name"]: r["type_name"] for r in n.infer_types(sample).collect()}
    lake.write(service.table, m.text_keys(n.typed(sample, types), list(service.key)).limit(0).withColumn(m.SYNCED, F.lit(None).cast("timestamp")), service.key)
    lake.append("keys", lake.spark.createDataFrame([(service.table, ",".join(service.key))], KEYS))


def store(lake: Lake, service: Service, pulled: DataFrame, now: datetime, date_field: str | None) -> dict[str, int]:
    """Normalise, set aside and merge what was pulled; counts of fetched, inserted, failed and skipped rows.

    Rows without a whole key go to quarantine and count as failed, or are dropped and count as skipped where the service says so. Rows dated in the
    future are stored and flagged. A value that its column's stored type can't hold sends its row to the failed rows."""
    key = list(service.key)
    seen, flat = Observation(), n.flatten(n.raw_copy(pulled, "whole_record") if service.keep_raw else pulled)
    flat = flat.withColumnRenamed("whole_record", "_raw_json") if service.keep_raw else flat
    flat = flat.withColumns({c: n.blank_to_null(F.col(f"`{c}`")) for c in service.json_fields})
    rows = stage(flat.observe(seen, F.count("*").alias("fetched"), F.count_if(m.keyless(key, service.allow_empty)).alias("invalid")), "pulled")
    counted = seen.get  # taken while the rows were written
    try:
        return _store(lake, service, rows, counted, now, date_field)
    finally:
        discard(rows)


def _store(lake: Lake, service: Service, rows: DataFrame, counted: dict[str, int], now: datetime, date_field: str | None) -> dict[str, int]:
    """store() of staged and counted rows."""
    key = list(service.key)
    if lake.version(service.table) < 0:
        types = {r["column_name"]: r["type_name"] for r in n.infer_types(rows).collect()}
        lake.write(service.table, m.text_keys(n.typed(rows, types), key).limit(0).withColumn(m.SYNCED, F.lit(None).cast("timestamp")), key)
        lake.append("keys", lake.spark.createDataFrame([(service.table, ",".join(key))], KEYS))
    stored = lake.read(service.table)
    good, bad = m.split_invalid(rows, key, service.allow_empty)
    text = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    as_text = T.StructType([T.StructField(f.name, f.dataType if f.name not in text or f.name not in stored.columns else stored.schema[f.name].dataType) for f in rows.schema.fields])
    target = n.widen(stored.schema, as_text, service.key)
    fits = T.StructType([f for f in target.fields if f.name in rows.columns])
    unfit = n.rejects(good, fits)
    unfit_rows = unfit.count()
    if counted["invalid"] and service.quarantine_invalid:
        lake.set_aside("quarantine", service.table, bad.drop("reason"), "missing or blank key")
    if date_field is not None:
        lake.set_aside("quarantine", service.table, s.flag_future(n.conform(good, fits), date_field, now.date()).drop("reason"), "date in the future, stored")
    if unfit_rows:
        lake.set_aside("failed", service.table, unfit, "a value doesn't fit its column")
        conditions = [F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in fits.fields]
        good = good.where(~reduce(lambda a, b: a | b, conditions))
    batch = m.last_wins(n.conform(good, fits), key, list(service.order))
    table = lake.table(service.table, key)
    table.merge(batch, F.lit(now))
    table.retain()
    failed = unfit_rows + (counted["invalid"] if service.quarantine_invalid else 0)
    kept = counted["fetched"] - unfit_rows - counted["invalid"]
    return {"fetched": counted["fetched"], "inserted": kept, "failed": failed, "skipped": counted["fetched"] - kept - failed}


def land_windows(lake: Lake, service: Service, rows: DataFrame, field: str, windows: list[tuple[date, date]]) -> Exception | None:
    """Land the windows that haven't yet, WINDOWS a job, each as a part with a mark; what went wrong in the first window that can't be pulled."""
    folder = f"{lake.root}/_pull/{service.name}"
    marks = set(children(lake.spark, f"{folder}/_done"))
    todo = [w for w in windows if f"{w[0]}_{w[1]}" not in marks]

    def land(some: list[tuple[date, date]]) -> None:
        part = F.coalesce(*[F.when(s.in_range(field, *w), F.lit(str(w[0]))) for w in some])
        some_rows = rows.where(s.in_range(field, some[0][0], some[-1][1])).withColumn("_window", part)
        some_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_window").parquet(f"{folder}/parts")
        for w in some:
            create_file(lake.spark, f"{folder}/_done/{w[0]}_{w[1]}", "")

    for k in range(0, len(todo), WINDOWS):
        try:
            land(todo[k : k + WINDOWS])
        except Exception:  # one of them: those before it land on their own
            for w in todo[k : k + WINDOWS]:
                try:
                    land([w])
                except Exception as e:
                    return e
    return None


def landed(lake: Lake, service: Service, rows: DataFrame, windows: list[tuple[date, date]]) -> tuple[DataFrame, int]:
    """What has landed of the windows up to the first that hasn't, and how many these are."""
    folder = f"{lake.root}/_pull/{service.name}"
    marks = set(children(lake.spark, f"{folder}/_done"))
    whole = next((k for k, w in enumerate(windows) if f"{w[0]}_{w[1]}" not in marks), len(windows))
    there = set(children(lake.spark, f"{folder}/parts"))
    parts = [f"{folder}/parts/{p}" for w in windows[:whole] if (p := f"_window={w[0]}") in there]  # an empty window has none
    return (lake.spark.read.schema(rows.schema).parquet(*parts) if parts else rows.limit(0)), whole


def pull_series(lake: Lake, service: Service, source: DataFrame, first: bool, full: bool, now: datetime) -> DataFrame:
    """Rows past the highest stored number of their series, and those of recent parents that have none (not on a full or first run)."""
    stored, parent = lake.read(service.table), lake.read(service.parent)
    if parent is None:
        raise ValueError(f"{service.name}: the table {service.parent} isn't there yet")
    high = s.series_high(stored if stored is not None else source.limit(0), service.series_field)
    rows = s.series_pull(source, s.series_scope(high, s.series_seen(parent, service.parent_field), False), service.series_field, full=full)
    if first or full:
        return rows
    known = stored.select(service.series_field).unionByName(rows.select(service.series_field))
    floor = now.date() - timedelta(days=service.lookback_days)
    gaps = s.missing_children(parent, service.parent_field, known, service.series_field, service.parent_date, floor, GAPS)
    return rows.unionByName(source.join(gaps.withColumnRenamed(service.parent_field, service.series_field), service.series_field, "left_semi").select(*rows.columns))


def run(lake: Lake, service: Service, source: DataFrame, now: datetime, full: bool = False, max_windows: int | None = None) -> str:
    """One run of a service; returns its status.

    The watermark becomes `now`, the wall clock and never a date of the data, after a run that pulled everything without a failed row. A backfill notes how
    far it came; one that was cut (max_windows) or failed goes on behind its last whole window. What raises is kept as the state's last error and leaves
    the watermark. Where the service has an open flag and its time has come, rows that are open there or here are read again as well."""
    state = lake.state(service.name)
    guard_key(lake, service)
    state = lake.save_state(state, now, status="in_progress", records_processed=None, records_failed=None, last_error=None)
    phase = service.strategy if service.strategy in ("full_refresh", "series") else s.plan_phase(full, state)
    counts, whole, through, broken = dict.fromkeys(("fetched", "inserted", "failed", "skipped"), 0), True, state["history_through"], None
    pulled = f"{lake.root}/_pull/{service.name}"
    try:
        rows = source.where(f"({service.static_filter})") if service.static_filter else source
        field, asked = None, rows
        if phase == "backfill":
            if full:
                remove(lake.spark, pulled)
            field, end = service.history_field, now.date() + timedelta(days=1)
            start = service.start if full or through is None else max(service.start, through)
            windows = s.windows(start, end, service.granularity)
            whole, windows = max_windows is None or len(windows) <= max_windows, windows[:max_windows]
            broken = land_windows(lake, service, rows, field, windows)
            asked, came = landed(lake, service, rows, windows)
            through = windows[came - 1][1] if came else through
        elif phase == "incremental":
            field = service.incremental_field or service.history_field
            asked = rows.where(s.since(field, state["last_sync_at"].date(), service.lookback_days, service.include_undated, service.extra_fields))
        elif phase == "series":
            asked = pull_series(lake, service, rows, state["last_sync_at"] is None, full, now)
        moved = {}
        if service.open_field and broken is None and lake.version(service.table) >= 0 and s.refresh_due(full, state.get("open_read_at"), now, service.open_hours):
            again, _ = s.open_refresh(lake.read(service.table), rows.withColumn(service.key[0], F.col(service.key[0]).cast("string")), service.key[0], service.open_field)
            asked, moved = asked.unionByName(again.drop("why").select(*[F.col(c).cast(rows.schema[c].dataType) for c in asked.columns])), {"open_read_at": now}
        counts = store(lake, service, asked, now, field)
        if phase == "backfill":
            remove(lake.spark, pulled)
        if broken is not None:
            raise broken
        status = "success" if not counts["failed"] else "partial_failure"
        moved |= {"last_sync_at": now} if whole and status == "success" else {}
        lake.save_state(state, now, status=status if whole else "in_progress", history_through=through, records_processed=counts["inserted"], records_failed=counts["failed"], **moved)
    except Exception as e:  # the boundary of a run: the state keeps what went wrong, and the windows that were merged before it
        status = "failed"
        kept = through if e is broken else state["history_through"]
        lake.save_state(state, now, status=status, history_through=kept, resume_from=kept if phase == "backfill" else None, records_processed=counts["inserted"], records_failed=counts["failed"], last_error=f"{type(e).__name__}: {e}"[:2000])
    summary = (service.name, state["step"], phase, counts["fetched"], counts["inserted"], counts["failed"], counts["skipped"], status)
    lake.append("summary", lake.spark.createDataFrame([summary], SUMMARY))
    return status


def backfill_range(lake: Lake, service: Service, source: DataFrame, start: date, end: date, now: datetime) -> dict[str, int]:
    """Pull [start, end) again without touching the service's state."""
    return store(lake, service, source.where(s.in_range(service.history_field, start, end)), now, service.history_field)
