"""Ingest strategies as plans over a source frame: date windows, watermarks, number series, gap sweeps and open entries."""

from __future__ import annotations

import warnings
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEVER = "0001-01-01"  # how an unset date arrives
STEPS = {"monthly": "month", "weekly": "week", "daily": "day"}


def windows(start: date, end: date, granularity: str = "monthly") -> list[tuple[date, date]]:
    """Half-open windows that cover [start, end): months begin on their first day after a partial first one."""
    if granularity not in (*STEPS, "none"):
        raise ValueError(f"unknown granularity {granularity!r}")
    out, at = [], start
    while at < end:
        if granularity == "none":
            nxt = end
        elif granularity == "monthly":
            nxt = date(at.year + at.month // 12, at.month % 12 + 1, 1)
        else:
            nxt = at + timedelta(days=7 if granularity == "weekly" else 1)
        out.append((at, min(nxt, end)))
        at = nxt
    return out


def window_frame(bounds: DataFrame, granularity: str = "monthly") -> DataFrame:
    """The windows of each row's [lo, hi) as rows (lo, hi, window_start, window_end), all in expressions."""
    if granularity == "none":
        return bounds.where("lo < hi").select("lo", "hi", F.col("lo").alias("window_start"), F.col("hi").alias("window_end"))
    unit = {"monthly": "1 month", "weekly": "7 days", "daily": "1 day"}[granularity]
    first = F.trunc("lo", "month") if granularity == "monthly" else F.col("lo")
    rows = bounds.where("lo < hi").withColumn("first", first).withColumn("at", F.explode(F.expr(f"sequence(first, date_sub(hi, 1), interval {unit})")))
    step = F.add_months("at", 1) if granularity == "monthly" else F.date_add("at", 7 if granularity == "weekly" else 1)
    return rows.select("lo", "hi", F.greatest("at", "lo").alias("window_start"), F.least(step, "hi").alias("window_end"))


def in_range(field: str, lo=None, hi=None) -> Column:
    """lo <= field < hi; an open end is left out."""
    parts = ([F.col(field) >= F.lit(lo)] if lo is not None else []) + ([F.col(field) < F.lit(hi)] if hi is not None else [])
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def since(field: str, watermark: date, lookback_days: int, include_undated: bool = False, extra: tuple[str, ...] = ()) -> Column:
    """Rows new or changed since the watermark less the lookback, by field or an extra field; undated rows on request."""
    floor = F.lit(watermark - timedelta(days=lookback_days))
    out = reduce(lambda a, b: a | b, [F.coalesce(F.col(f) >= floor, F.lit(False)) for f in (field, *extra)])
    return out | F.coalesce(F.col(field) == F.lit(NEVER).cast("date"), F.lit(False)) if include_undated else out


def series_of(field: str, sep: str = "-") -> Column:
    return F.split_part(F.col(field), F.lit(sep), F.lit(1))


def series_high(stored: DataFrame, field: str, sep: str = "-") -> DataFrame:
    """The largest number of each series (the part before sep)."""
    return stored.where(F.coalesce(F.col(field), F.lit("")) != "").groupBy(series_of(field, sep).alias("series")).agg(F.max(field).alias("high")).where("series <> ''")


def series_seen(parent: DataFrame, field: str, date_field: str | None = None, floor: date | None = None, sep: str = "-") -> DataFrame:
    """Series that occur in parent, of rows from floor on where a floor is given."""
    if date_field is not None and date_field not in parent.columns:
        raise ValueError(f"{date_field} is not a column of the parent")
    rows = parent if floor is None else parent.where(F.col(date_field) >= F.lit(floor))
    return rows.where(F.coalesce(F.col(field), F.lit("")) != "").select(series_of(field, sep).alias("series")).where("series <> ''").distinct()


def series_scope(high: DataFrame, seen: DataFrame, dated: bool) -> DataFrame:
    """series, high to pull: a dated parent's series replace the stored ones, otherwise both count."""
    return seen.join(high, "series", "left") if dated else seen.unionByName(high.select("series")).distinct().join(high, "series", "left")


def series_pull(source: DataFrame, scope: DataFrame, field: str, sep: str = "-", full: bool = False) -> DataFrame:
    """Source rows past the high number of their series; all of the series in full mode."""
    rows = source.withColumn("series", series_of(field, sep)).join(scope, "series")
    return rows.where(F.lit(full) | F.col("high").isNull() | (F.col(field) > F.col("high"))).drop("series", "high")


def missing_children(parent: DataFrame, key: str, child: DataFrame, child_key: str, date_field: str | None = None, floor: date | None = None, limit: int = 200) -> DataFrame:
    """Parent keys without a child row, the highest first, at most `limit` a run (the next run goes on)."""
    rows = parent if floor is None else parent.where(F.col(date_field) >= F.lit(floor))
    return rows.select(key).where(F.col(key).isNotNull()).distinct().join(child.select(F.col(child_key).alias(key)).distinct(), key, "left_anti").orderBy(F.col(key).desc()).limit(limit)


def open_refresh(stored: DataFrame, source: DataFrame, key: str, open_field: str = "open") -> tuple[DataFrame, DataFrame]:
    """(source rows to merge with why: open there, or held open here and re-read; keys held open here that the source lacks).

    A source that answers with no open row while some are held open here has a broken filter rather than nothing open: a warning, and nothing is re-read."""
    is_open = F.coalesce(F.col(open_field), F.lit(False))
    held, there = stored.where(is_open).select(key), source.where(is_open)
    if not there.limit(1).count() and (n_held := held.count()):
        warnings.warn(f"the source has no open row, {n_held} are held open here; they are not read again", stacklevel=2)
        held = held.limit(0)
    again = held.join(there.select(key), key, "left_anti")
    reread = source.join(again, key, "left_semi")
    return there.withColumn("why", F.lit("open")).unionByName(reread.withColumn("why", F.lit("reread"))), again.join(source.select(key), key, "left_anti")


def refresh_due(full: bool, last, now, every_hours: int) -> bool:
    return full or last is None or now - last >= timedelta(hours=every_hours)


def flag_future(df: DataFrame, field: str, today: date) -> DataFrame:
    """Rows dated after today; they are stored as well."""
    return df.where(F.col(field) > F.lit(today)).withColumn("reason", F.lit("date in the future"))


def corrupt_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a replacement character in one of the columns."""
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.col(c), F.lit("�")), F.lit(False)) for c in columns]))


def repair_text(stored: DataFrame, source: DataFrame, key: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(source rows of the keys whose stored text is corrupt, for a merge; one row: how many keys were corrupt, and would still be after it)."""
    bad = corrupt_text(stored, columns).select(*key).distinct()
    again = source.join(bad, key, "left_semi")
    left = bad.join(again.select(*key), key, "left_anti").unionByName(corrupt_text(again, columns).select(*key)).distinct()
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return again, count(bad, "corrupt_before").crossJoin(count(left, "corrupt_after"))  # two single rows


def fit_integers(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(df with the columns rounded half to even into long, one row with how many values had a fraction)."""
    fitted = df.withColumns({c: F.bround(F.col(c), 0).cast("long") for c in columns})
    return fitted, df.agg(*[F.count_if(F.col(c) != F.bround(F.col(c), 0)).alias(c) for c in columns])


def plan_phase(full: bool, state: dict | None) -> str:
    """Backfill until a first watermark stands, then incremental."""
    return "backfill" if full or not state or state.get("last_sync_at") is None else "incremental"


def next_state(state: dict, status: str, now, resume: str | None = None, rows: int = 0, failed: int = 0, error: str | None = None) -> dict:
    """The state row after a run: only success moves the watermark, to the wall clock; a resume link outlives only a failed run."""
    if status not in ("success", "partial_failure", "failed"):
        raise ValueError(f"unknown status {status!r}")
    return state | {
        "status": status, "last_run_completed_at": now, "records_processed": rows, "records_failed": failed, "last_error": error,
        "last_sync_at": now if status == "success" else state.get("last_sync_at"), "resume_url": resume if status == "failed" else None,
    }


def run_counters(fetched: DataFrame, stored_ok: DataFrame, failed: DataFrame) -> DataFrame:
    """fetched, inserted, failed and skipped (the rest) of a run."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    joined = one(fetched, "fetched").crossJoin(one(stored_ok, "inserted")).crossJoin(one(failed, "failed"))  # three single rows
    return joined.withColumn("skipped", F.col("fetched") - F.col("inserted") - F.col("failed"))
