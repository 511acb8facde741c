"""Ingest runs over the fixtures: a backfill in two parts, an incremental run, a refresh, rows set aside, and the state that each leaves."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import Tables, with_tables
from ..plans import ingest_run as run
from ..plans.buckets import BucketTable
from ..plans.stages import shared_folder
from .common import money, settled

FIRST, SECOND, BEGIN, LOOKBACK = datetime(1996, 12, 31, 6), datetime(1997, 6, 30, 6), date(1992, 1, 1), 60
SERVICE = run.Service("Sales_Invoices", "t_sales_invoices", ("no",), ("posting_date", "amount"), history_field="posting_date", start=BEGIN, lookback_days=LOOKBACK)
COLUMNS = ("no", "customer_no", "posting_date", "amount")


def _lake(spark: SparkSession) -> run.Lake:
    return run.Lake(spark, f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}")


def _source(t: Tables) -> DataFrame:
    """What the service answers at first."""
    return t.invoice_header.select(*COLUMNS)


def _later(t: Tables) -> DataFrame:
    """What it answers half a year on: amounts of one invoice in ten have changed, and there is a new column."""
    return t.invoice_header.select("no", "customer_no", "posting_date", F.when(F.col("k") % 10 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,4)").alias("amount"), "eway_no")


def _backfilled(t: Tables, spark: SparkSession) -> run.Lake:
    """Two years of windows, then the rest: the second run goes on where the first stopped."""
    lake = _lake(spark)
    run.run(lake, SERVICE, _source(t), FIRST, max_windows=24)
    run.run(lake, SERVICE, _source(t), FIRST)
    return lake


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a backfill in two runs."""
    return settled(_backfilled(Tables(spark, sf_dir), spark).read(SERVICE.table).select(*COLUMNS))


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a later run: rows from the watermark less the lookback on are new or changed, older ones as they were."""
    t = Tables(spark, sf_dir)
    lake = _backfilled(t, spark)
    run.run(lake, SERVICE, _later(t), SECOND)
    return settled(lake.read(SERVICE.table).select(*COLUMNS, "eway_no"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All states that these three runs leave, in their order."""
    t = Tables(spark, sf_dir)
    lake = _backfilled(t, spark)
    run.run(lake, SERVICE, _later(t), SECOND)
    return lake.side("state", run.STATE).where("status <> 'in_progress' or records_processed is not null").select("step", "status", "last_sync_at", "history_through", "records_processed", "records_failed")


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a refresh whose source has rows without a key, and of the same one for a service that drops them quietly."""
    t = Tables(spark, sf_dir)
    lake = _lake(spark)
    for name, quarantine in (("kept", True), ("quiet", False)):
        service = run.Service(name, f"t_{name}", ("external_no",), ("no",), strategy="full_refresh", quarantine_invalid=quarantine, static_filter="no is not null or false")
        run.run(lake, service, t.invoice_header.select("external_no", "no", "posting_date"), FIRST)
    return lake.side("summary", run.SUMMARY).select("service_name", "phase", "fetched", "inserted", "failed", "skipped", "status")


def set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that runs set aside: blank keys, dates in the future (these are stored as well) and values that no longer fit their column."""
    t = Tables(spark, sf_dir)
    lake = _lake(spark)
    service = run.Service("Memos", "t_memos", ("external_no",), ("no",), history_field="posting_date", start=BEGIN)
    rows = t.memo_header.select("external_no", "no", "posting_date", "amount")
    run.run(lake, service, rows.where(F.col("posting_date") < F.lit(date(1995, 1, 1))), datetime(1994, 12, 31))
    unfit = rows.withColumn("amount", F.when(F.col("no").endswith("7"), F.lit("n/a")).otherwise(F.col("amount").cast("string")))
    run.backfill_range(lake, service, unfit, date(1996, 1, 1), date(1998, 1, 1), datetime(1997, 1, 1))
    sides = [lake.side(x, run.SIDE).select(F.lit(x).alias("side"), "reason", F.get_json_object("row", "$.no").alias("no")) for x in ("quarantine", "failed")]
    return sides[0].unionByName(sides[1])


BROKEN, MENDED = date(1995, 9, 1), date(1995, 10, 1)


def _resumed(t: Tables, spark: SparkSession) -> run.Lake:
    """A backfill whose source fails in one month, and the run after it. By then the source has other amounts, which tells what was pulled when."""
    lake, day = _lake(spark), F.col("posting_date")
    fails = (day >= F.lit(BROKEN)) & (day < F.lit(MENDED))
    broken = F.when(fails, F.raise_error(F.lit("no answer")).cast("decimal(18,4)")).otherwise(F.col("amount"))
    run.run(lake, SERVICE, _source(t).withColumn("amount", broken), FIRST)
    run.run(lake, SERVICE, _source(t).withColumn("amount", (F.col("amount") + 2).cast("decimal(18,4)")), FIRST)
    return lake


def resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a backfill that failed half-way and was resumed: whole windows aren't pulled again."""
    return settled(_resumed(Tables(spark, sf_dir), spark).read(SERVICE.table).select(*COLUMNS))


def resumed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states that these runs leave."""
    states = _resumed(Tables(spark, sf_dir), spark).side("state", run.STATE).where("status <> 'in_progress'")
    return states.select("step", "status", "history_through", "records_processed", F.contains("last_error", F.lit("no answer")).alias("told"), "resume_from")


SERIES_BACK = 800


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines pulled by the series of their documents, in two runs; the second asks again for recent documents that have no line."""
    t, lake = Tables(spark, sf_dir), _lake(spark)
    heads = run.Service("Heads", "t_heads", ("no",), ("posting_date",), strategy="full_refresh")
    lines = run.Service("Lines", "t_lines", ("document_no", "line_no"), ("document_no",), strategy="series", series_field="document_no", parent="t_heads", parent_field="no", parent_date="posting_date", lookback_days=SERIES_BACK)
    run.run(lake, heads, t.invoice_header.select("no", "posting_date"), FIRST)
    early = t.invoice_header.where((F.col("k") % 10 != 3) & (F.col("posting_date") < F.lit(date(1996, 1, 1)))).select(F.col("no").alias("document_no"))
    source = t.invoice_line.select("document_no", "line_no", "quantity")
    run.run(lake, lines, source.join(early, "document_no", "left_semi"), FIRST)
    run.run(lake, lines, source, SECOND)
    return settled(lake.read("t_lines").select("document_no", "line_no", "quantity"))


def open_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after a later run that reads again what is open, there or here, besides what is new."""
    t, lake = Tables(spark, sf_dir), _lake(spark)
    service = run.Service("Orders", "t_orders", ("k",), ("d",), history_field="d", start=BEGIN, lookback_days=LOOKBACK, open_field="open")
    first = t.order_base.select("k", "d", (F.col("st") == "O").alias("open"), "total")
    flipped = F.when(F.col("k") % 33 == 0, F.col("st") != "O").otherwise(F.col("st") == "O")
    second = t.order_base.where("k % 50 <> 7").select("k", "d", flipped.alias("open"), (F.col("total") + 1).cast("decimal(18,4)").alias("total"))
    run.run(lake, service, first, FIRST)
    run.run(lake, service, second, SECOND)
    return settled(lake.read("t_orders").select("k", "open", "total"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A service that keeps each record as it came, with blank JSON as null."""
    t, lake = Tables(spark, sf_dir), _lake(spark)
    service = run.Service("Raw", "t_raw", ("no",), ("no",), strategy="full_refresh", keep_raw=True, json_fields=("extra",))
    extra = F.when(F.col("k") % 3 == 0, F.lit("")).when(F.col("k") % 3 == 1, F.lit("  ")).otherwise(F.concat(F.lit('{"k":'), F.col("k").cast("string"), F.lit("}")))
    run.run(lake, service, t.invoice_header.select("no", "customer_no", extra.alias("extra"), F.struct("location_code").alias("place")), FIRST)
    kept = [F.get_json_object("_raw_json", path).alias(name) for path, name in (("$.customer_no", "raw_customer"), ("$.place.location_code", "raw_place"), ("$.extra", "raw_extra"))]
    return lake.read("t_raw").select("no", "customer_no", "extra", "place_location_code", *kept)


def partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed table after a merge of its latest documents, which rewrites the buckets that these touch, and a repeated commit of it."""
    t = Tables(spark, sf_dir)
    table = BucketTable(spark, f"{shared_folder(spark)}/bucketed-{uuid.uuid4().hex}", ["no"], 64)
    table.merge(_source(t), F.lit(FIRST))
    late = _later(t).where("posting_date >= date'2001-07-25'")
    for _ in range(2):
        table.merge(late, F.lit(SECOND), tag="late")
    return settled(table.read().select(*COLUMNS, "eway_no", "_synced_at"))


QUERIES = {"run_backfill": backfill, "run_incremental": incremental, "run_state": history, "run_summary": summary, "run_set_aside": set_aside, "run_resume": resumed, "run_resume_state": resumed_state, "run_series": series, "run_open": open_entries, "mrg_partial": partial, "run_raw": raw}

_OLD, _NEW = "posting_date < date '1997-01-01'", f"posting_date >= date '1996-12-31' - {LOOKBACK}"
_ASK = {
    "run_backfill": f"select no, customer_no, posting_date, {money('amount')} from invoice_header where posting_date >= date '1992-01-01' and {_OLD}",
    "run_incremental": f"""select no, customer_no, posting_date, round(cast(if({_NEW} and k % 10 = 0, amount + 1, amount) as double), 4) as amount, if({_NEW}, eway_no, null) as eway_no
        from invoice_header where posting_date >= date '1992-01-01' and ({_OLD} or {_NEW})""",
    "run_resume": f"select no, customer_no, posting_date, round(cast(if(posting_date >= date '{BROKEN}', amount + 2, amount) as double), 4) as amount from invoice_header where posting_date >= date '1992-01-01' and {_OLD}",
    "run_resume_state": f"""select s.step, s.status, s.through as history_through, (select count(*) from invoice_header where posting_date >= s.lo and posting_date < s.through) as records_processed, s.told, s.resume_from from (values
        (2, 'failed', date '{BROKEN}', date '1992-01-01', true, date '{BROKEN}'), (4, 'success', date '1997-01-01', date '{BROKEN}', cast(null as boolean), null)) s(step, status, through, lo, told, resume_from)""",
    "run_series": f"""select document_no, line_no, {money('quantity')} from invoice_line where document_no in (select document_no from early_lines) or document_no in (select document_no from past_lines) or document_no in (select no from gap_heads)""",
    "run_open": f"""select cast(k as varchar) as k, if(again, now_open, was_open) as open, round(cast(if(again, total + 1, total) as double), 4) as total from (
        select k, d, total, st = 'O' as was_open, if(k % 33 = 0, st <> 'O', st = 'O') as now_open, d < date '1997-01-01' as held,
               k % 50 <> 7 and (d >= date '1996-12-31' - {LOOKBACK} or now_open or held and was_open) as again from order_base) where held or again""",
    "run_raw": """select no, customer_no, if(k % 3 = 2, '{"k":' || k || '}', null) as extra, location_code as place_location_code, customer_no as raw_customer, location_code as raw_place,
        case k % 3 when 0 then '' when 1 then '  ' else '{"k":' || k || '}' end as raw_extra from invoice_header""",
    "mrg_partial": f"""select no, customer_no, posting_date, round(cast(if(late and k % 10 = 0, amount + 1, amount) as double), 4) as amount, if(late, eway_no, null) as eway_no,
        if(late and (k % 10 = 0 or eway_no is not null), timestamp '1997-06-30 06:00:00', timestamp '1996-12-31 06:00:00') as _synced_at from (select *, posting_date >= date '2001-07-25' as late from invoice_header)""",
    "run_state": f"""select s.step, s.status, s.last_sync_at, s.history_through, (select count(*) from invoice_header where posting_date >= s.lo and posting_date < s.hi) as records_processed, 0 as records_failed from (values
        (2, 'in_progress', cast(null as timestamp), date '1994-01-01', date '1992-01-01', date '1994-01-01'), (4, 'success', timestamp '1996-12-31 06:00:00', date '1997-01-01', date '1994-01-01', date '1997-01-01'),
        (6, 'success', timestamp '1997-06-30 06:00:00', date '1997-01-01', date '1996-12-31' - {LOOKBACK}, date '9999-01-01')) s(step, status, last_sync_at, history_through, lo, hi)""",
    "run_summary": """with c as (select count(*) as n, count(*) filter (external_no is null or trim(external_no) = '') as bad from invoice_header)
        select 'kept' as service_name, 'full_refresh' as phase, n as fetched, n - bad as inserted, bad as failed, 0 as skipped, if(bad = 0, 'success', 'partial_failure') as status from c
        union all select 'quiet', 'full_refresh', n, n - bad, 0, bad, 'success' from c""",
    "run_set_aside": """with early as (select * from memo_header where posting_date >= date '1992-01-01' and posting_date < date '1995-01-01'), late as (select * from memo_header where posting_date >= date '1996-01-01' and posting_date < date '1998-01-01')
        select 'quarantine' as side, 'missing or blank key' as reason, no from (select * from early union all select * from late) where external_no is null or trim(external_no) = ''
        union all select 'quarantine', 'date in the future, stored', no from late where posting_date > date '1997-01-01' and not (external_no is null or trim(external_no) = '')
        union all select 'failed', 'a value doesn''t fit its column', no from late where no like '%7' and not (external_no is null or trim(external_no) = '')""",
}
_STEPS = {
    "early_lines": "select l.document_no, split_part(l.document_no, '-', 1) as series from invoice_line l join invoice_header h on h.no = l.document_no where h.k % 10 <> 3 and h.posting_date < date '1996-01-01'",
    "highs": "select series, max(document_no) as high from early_lines group by series",
    "past_lines": "select l.document_no from invoice_line l left join highs on series = split_part(l.document_no, '-', 1) where high is null or l.document_no > high",
    "gap_heads": f"""select no from invoice_header where posting_date >= date '1997-06-30' - {SERIES_BACK} and no not in (select document_no from early_lines) and no not in (select document_no from past_lines)
        order by no desc limit {run.GAPS}""",
}
ORACLE_SQL = {name: with_tables(sql, _STEPS) for name, sql in _ASK.items()}
ORACLE_SQL["run_summary"] = with_tables("select 1 from invoice_header").rsplit("\n", 1)[0] + ",\n" + _ASK["run_summary"].removeprefix("with ")
ORACLE_SQL["run_set_aside"] = with_tables("select 1 from memo_header").rsplit("\n", 1)[0] + ",\n" + _ASK["run_set_aside"].removeprefix("with ")
