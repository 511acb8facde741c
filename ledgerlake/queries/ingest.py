"""Ingest strategies, normalisation and merge over the fixtures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..fixtures import Tables, fixture, with_tables
from ..functions import normalize as n
from ..operators import merge as m
from ..operators import strategies as s
from .common import money, settled

MARK, FLOOR, STORED_TO = date(2000, 3, 1), date(2000, 1, 1), date(1995, 1, 1)
SLIM = ("no", "customer_no", "posting_date", "amount")


def _step(build, written=True):
    return lambda spark, sf_dir: settled(build(Tables(spark, sf_dir, written)))


def _stored(t):
    """The table as an earlier run left it: three of four invoices, some amounts since changed, without the column `eway_no`."""
    old = t.invoice_header.where("k % 4 <> 1").select(*SLIM, "k")
    return old.select("no", "customer_no", "posting_date", F.when(F.col("k") % 10 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,4)").alias("amount"), F.when(F.col("k") % 6 == 0, "kept").alias("own_note"), F.lit("1999-01-01 00:00:00").cast("timestamp").alias("_synced_at"))


def _batch(t):
    return t.invoice_header.where("k % 2 = 0 or k % 4 = 1").select(*SLIM, "eway_no")


def _merged(t):
    return m.merge(_stored(t), _batch(t), ["no"], F.lit("2000-01-01 00:00:00").cast("timestamp"))


def _records(t):
    """Nested records as they land."""
    return t.invoice_header.select(
        F.lit("etag").alias("@odata.etag"), F.col("no").alias("No."), F.struct(F.col("location_code").alias("City"), F.struct("state_dim", F.lit(1).alias("@odata.id")).alias("Dim")).alias("Address"), F.array("bill_state", "ship_state").alias("States"), F.col("amount").cast("string").alias("2nd amount")
    )


# Columns with all kinds of content, in SQL that both engines read; DuckDB lacks Spark's type names, so its SQL looks at the values.
_CONTENT = {
    "no": "no", "posting_date": "cast(posting_date as string)", "k": "k", "code": "lpad(cast(k as string), 9, '0')", "amount": "amount", "cancelled": "cancelled", "said": "case when cancelled then 'true' else 'false' end",
    "mixed": "case when k % 2 = 0 then cast(posting_date as string) else cast(k as string) end", "stamp": "concat(cast(posting_date as string), 'T00:00:00Z')", "either": "case when k % 2 = 0 then concat(cast(posting_date as string), 'T00:00:00Z') else concat(' ', cast(posting_date as string)) end",
    "day": "posting_date", "none": "cast(null as string)", "odd_day": "case when k % 5 = 0 then '2024-02-30' else cast(posting_date as string) end",
}


def _typed(t):
    return n.infer_types(t.invoice_header.selectExpr(*[f"{v} as {k}" for k, v in _CONTENT.items()]))


def _infer_sql() -> str:
    """A count of the values of each kind, and the widest kind among them."""
    arms = []
    for name, value in _CONTENT.items():
        v = f"trim(cast({name} as varchar))"
        arms.append(f"""select '{name}' as column_name, typeof(any_value({name})) as kind, count({name}) as n, count(*) filter (regexp_matches({v}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')) as n_time,
            count(*) filter (regexp_matches({v}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) as n_date from (select {value} as {name} from invoice_header)""")
    return f"""select column_name, case when n = 0 then 'string' when kind = 'BOOLEAN' then 'boolean' when kind like 'DECIMAL%' then 'decimal(18,4)' when kind in ('BIGINT', 'INTEGER') then 'bigint' when kind = 'DATE' then 'date'
        when n > n_time + n_date then 'string' when n_time > 0 then 'timestamp' else 'date' end as type_name from ({" union all ".join(arms)})"""


_SAID = "case k % 6 when 0 then cast(posting_date as string) when 1 then ' ' || cast(posting_date as string) || 'T10:20:30Z' when 2 then '2023-02-30' when 3 then '2023-13-01T00:00:00Z' when 4 then no end"
_RAW_NAME = "case p_partkey % 8 when 0 then p_name when 1 then p_brand || '__' || p_type || '.' when 2 then cast(p_size as string) || ' ' || p_brand when 3 then 'Rank' when 4 then '_Row-' when 5 then '%' when 6 then p_type || ' ' || p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_type else 'User' end"


_LINES = "select cast(l_orderkey as varchar) as a, cast(l_linenumber as varchar) as b, count(*) as n_rows from lineitem group by 1, 2"


def _lineitem(t):
    return fixture(*t._at, "lineitem")


def _widened(t):
    """Stored numbers and codes of digits, and a batch with amounts and text in their place and a new column, under the schema that holds both."""
    stored = t.invoice_header.where("k % 3 <> 0").selectExpr("no", "k as n", "cast(k % 100 as int) as code")
    batch = t.invoice_header.where("k % 3 = 0").selectExpr("no", "amount as n", "external_no as code", "eway_no")
    both = n.widen(stored.schema, batch.schema, ("no",))
    return n.conform(stored, both).unionByName(n.conform(batch, both))


def _preserved(t):
    """A merge that leaves the customer of stored rows alone, whatever the batch says."""
    batch = t.invoice_header.where("k % 2 = 0 or k % 4 = 1").select("no", F.lit("C99999").alias("customer_no"), "posting_date", "amount")
    return m.merge(_stored(t).drop("own_note"), batch, ["no"], F.lit(MARK).cast("timestamp"), preserve=("customer_no",)).select("no", "customer_no", "posting_date", "amount", F.col("_action").alias("action"))


def _guarded(t):
    """What an open refresh does with a source that answers, and with one whose filter answers nothing while rows are held open here."""
    held, out = t.order_base.selectExpr("k", "st = 'O' as open"), []
    for name, flag in (("answers", "if(k % 33 = 0, st <> 'O', st = 'O')"), ("silent", "false")):
        rows, missing = s.open_refresh(held, t.order_base.where("k % 50 <> 7").selectExpr("k", f"{flag} as open"), "k")
        both = rows.select("why").unionByName(missing.select(F.lit("missing").alias("why")))
        out.append(both.agg(F.lit(name).alias("source"), F.count_if(F.col("why") == "open").alias("open_there"), F.count_if(F.col("why") == "reread").alias("reread"), F.count_if(F.col("why") == "missing").alias("missing")))
    return out[0].unionByName(out[1])


QUERIES = {
    "ing_windows": _step(lambda t: s.window_frame(t.invoice_header.groupBy("location_code").agg(F.min("posting_date").alias("lo"), F.max("posting_date").alias("hi")).select("lo", "hi").distinct())),
    "ing_range": _step(lambda t: t.invoice_header.where(s.in_range("posting_date", FLOOR, MARK)).select(*SLIM)),
    "ing_incremental": _step(lambda t: t.invoice_header.where(s.since("export_date", MARK, 30, include_undated=True)).select("no", F.nullif(F.col("export_date"), F.lit(s.NEVER).cast("date")).alias("export_date"))),
    "ing_extra_pass": _step(lambda t: t.memo_header.where(s.since("document_date", MARK, 10, extra=("posting_date",))).select("no", "document_date", "posting_date")),
    "ing_series_high": _step(lambda t: s.series_high(t.invoice_header, "no")),
    "ing_series_new": _step(lambda t: s.series_scope(s.series_high(t.invoice_header.where("k % 4 <> 1"), "no"), s.series_seen(t.invoice_header, "no", "posting_date", FLOOR), True)),
    "ing_series_pull": _step(lambda t: s.series_pull(t.invoice_line.select("document_no", "line_no", "quantity"), s.series_scope(s.series_high(t.invoice_line.join(t.invoice_header.where(F.col("posting_date") < F.lit(STORED_TO)).select(F.col("no").alias("document_no")), "document_no", "left_semi"), "document_no"), s.series_seen(t.invoice_header, "no"), False), "document_no")),
    "ing_gap_sweep": _step(lambda t: s.missing_children(t.invoice_header, "no", t.invoice_line, "document_no", "posting_date", date(1996, 1, 1))),
    "ing_open_refresh": _step(lambda t: s.open_refresh(t.order_base.selectExpr("k", "st = 'O' as open"), t.order_base.where("k % 50 <> 7").selectExpr("k", "if(k % 33 = 0, st <> 'O', st = 'O') as open"), "k")[0]),
    "ing_open_missing": _step(lambda t: s.open_refresh(t.order_base.selectExpr("k", "st = 'O' as open"), t.order_base.where("k % 50 <> 7").selectExpr("k", "if(k % 33 = 0, st <> 'O', st = 'O') as open"), "k")[1]),
    "ing_open_guard": _step(_guarded),
    "ing_widen": _step(_widened),
    "mrg_preserve": _step(_preserved),
    "ing_table_names": lambda spark, sf_dir: fixture(spark, sf_dir, "part").select("p_partkey", n.safe_table(F.concat(F.lit(" "), F.col("p_name"), F.when(F.col("p_partkey") % 2 == 0, "__Excel").otherwise(" (V2)!"))).alias("table_name")),
    "ing_future": _step(lambda t: s.flag_future(t.invoice_header.select(*SLIM), "posting_date", date(2001, 1, 1))),
    "ing_corrupt_text": _step(lambda t: s.corrupt_text(t.invoice_header, ["external_no", "ship_to_name"]).select("no", "external_no")),
    "ing_fit_type": _step(lambda t: s.fit_integers(t.invoice_line.select("document_no", "line_no", "line_amount"), ["line_amount"])[0], written=False),
    "ing_fit_count": _step(lambda t: s.fit_integers(t.invoice_line.select("line_amount", "unit_price"), ["line_amount", "unit_price"])[1], written=False),
    "ing_infer": _step(_typed),
    "ing_temporal": _step(lambda t: t.invoice_header.select("no", n.temporal(F.expr(_SAID)).alias("t")).select("no", "t.day", F.date_format("t.instant", "yyyy-MM-dd HH:mm:ss").alias("instant"), "t.text")),
    "ing_names": _step(lambda t: fixture(*t._at, "part").select("p_partkey", n.safe_name(F.expr(_RAW_NAME)).alias("column_name"))),
    "ing_repair": _step(lambda t: s.repair_text(t.invoice_header.select("no", "external_no"), t.invoice_header.where("k % 3 <> 0").select("no", F.when(F.col("k") % 2 == 0, F.replace("external_no", F.lit("\ufffd"), F.lit("é"))).otherwise(F.col("external_no")).alias("external_no")), ["no"], ["external_no"])[1]),
    "mrg_changes": _step(lambda t: m.changes(_merged(t))),
    "ing_flatten": _step(lambda t: n.flatten(_records(t))),
    "mrg_upsert": _step(lambda t: _merged(t).drop("_action")),
    "mrg_skip_unchanged": _step(lambda t: _merged(t).groupBy("_action").agg(F.count("*").alias("n_rows")).withColumnRenamed("_action", "action")),
    "mrg_invalid_keys": _step(lambda t: m.split_invalid(t.invoice_header.selectExpr("no", "ship_to_code", "external_no"), ["external_no", "ship_to_code"], ("external_no",))[1]),
    "mrg_dup_keys": _step(lambda t: m.duplicate_keys(_lineitem(t), ["l_orderkey", "l_linenumber"])),
    "mrg_last_wins": _step(lambda t: m.last_wins(t.invoice_header.select("customer_no", "no", "posting_date"), ["customer_no"], ["posting_date", "no"])),
    "mrg_rekey_check": _step(lambda t: m.duplicate_keys(m.text_keys(_lineitem(t).select(F.col("l_orderkey").alias("a"), F.col("l_linenumber").alias("b")), ["a", "b"]), ["a", "b"])),
}

_MERGE = """
    with_old as (select no, customer_no, posting_date, cast(if(k % 10 = 0, amount + 1, amount) as decimal(18,4)) as amount, if(k % 6 = 0, 'kept', null) as own_note from invoice_header where k % 4 <> 1),
    with_new as (select no, customer_no, posting_date, amount, eway_no from invoice_header where k % 2 = 0 or k % 4 = 1)"""
_STEPS = {"old_rows": _MERGE.split("with_old as (", 1)[1].split("),\n", 1)[0], "new_rows": _MERGE.split("with_new as (", 1)[1][:-1]}
_BOTH = "old_rows o full join new_rows n on o.no = n.no"
_ACTION = "case when o.no is null then 'insert' when n.no is not null and (o.customer_no, o.posting_date, o.amount, null) is distinct from (n.customer_no, n.posting_date, n.amount, n.eway_no) then 'update' else 'keep' end"
_HELD = "select k, st = 'O' as held, k % 50 <> 7 as there, if(k % 33 = 0, st <> 'O', st = 'O') as open from order_base"

_ASK = {
    "ing_windows": """with r as (select distinct lo, hi from (select min(posting_date) as lo, max(posting_date) as hi from invoice_header group by location_code))
        select lo, hi, greatest(cast(m as date), lo) as window_start, least(cast(m + interval 1 month as date), hi) as window_end from (select lo, hi, unnest(range(cast(date_trunc('month', lo) as timestamp), cast(hi as timestamp), interval 1 month)) as m from r)""",
    "ing_range": f"select no, customer_no, posting_date, {money('amount')} from invoice_header where posting_date between date '2000-01-01' and date '2000-02-29'",
    "ing_incremental": "select no, nullif(export_date, date '0001-01-01') as export_date from invoice_header where export_date >= date '2000-01-31' or export_date = date '0001-01-01'",
    "ing_extra_pass": "select no, document_date, posting_date from memo_header where document_date >= date '2000-02-20' or posting_date >= date '2000-02-20'",
    "ing_series_high": "select split_part(no, '-', 1) as series, max(no) as high from invoice_header group by 1",
    "ing_series_new": "select a.series, b.high from (select distinct split_part(no, '-', 1) as series from invoice_header where posting_date >= date '2000-01-01') a left join (select split_part(no, '-', 1) as series, max(no) as high from invoice_header where k % 4 <> 1 group by 1) b using (series)",
    "ing_series_pull": f"""select l.document_no, l.line_no, {money("l.quantity")} from invoice_line l left join (select split_part(document_no, '-', 1) as series, max(document_no) as high from invoice_line where document_no in (select no from invoice_header where posting_date < date '1995-01-01') group by 1) h on h.series = split_part(l.document_no, '-', 1)
        where h.high is null or l.document_no > h.high""",
    "ing_gap_sweep": "select no from invoice_header where posting_date >= date '1996-01-01' and no not in (select document_no from invoice_line) order by no desc limit 200",
    "ing_open_refresh": f"select k, open, if(open, 'open', 'reread') as why from ({_HELD}) where there and (open or held)",
    "ing_open_guard": f"""select 'answers' as source, count(*) filter (there and open) as open_there, count(*) filter (there and not open and held) as reread, count(*) filter (held and not there) as missing from ({_HELD})
        union all select 'silent', 0, 0, 0""",
    "ing_widen": "select no, if(k % 3 = 0, round(cast(amount as double), 4), cast(k as double)) as n, if(k % 3 = 0, external_no, cast(k % 100 as varchar)) as code, if(k % 3 = 0, eway_no, null) as eway_no from invoice_header",
    "mrg_preserve": """select coalesce(o.no, h.no) as no, coalesce(o.customer_no, 'C99999') as customer_no, coalesce(o.posting_date, h.posting_date) as posting_date, round(cast(if(h.no is null, o.amount, h.amount) as double), 4) as amount,
        case when o.no is null then 'insert' when h.no is not null and o.amount <> h.amount then 'update' else 'keep' end as action
        from old_rows o full join (select * from invoice_header where k % 2 = 0 or k % 4 = 1) h on h.no = o.no""",
    "ing_table_names": "select p_partkey, 't_' || trim(regexp_replace(lower(' ' || p_name || if(p_partkey % 2 = 0, '', ' (V2)!')), '[^0-9a-z]+', '_', 'g'), '_') as table_name from part",
    "ing_open_missing": f"select k from ({_HELD}) where held and not there",
    "ing_future": f"select no, customer_no, posting_date, {money('amount')}, 'date in the future' as reason from invoice_header where posting_date > date '2001-01-01'",
    "ing_corrupt_text": "select no, external_no from invoice_header where contains(external_no || coalesce(ship_to_name, ''), '�')",
    "ing_fit_type": "select document_no, line_no, cast(round_even(line_amount, 0) as bigint) as line_amount from invoice_line",
    "ing_fit_count": "select count(*) filter (line_amount % 1 <> 0) as line_amount, count(*) filter (unit_price % 1 <> 0) as unit_price from invoice_line",
    "ing_infer": _infer_sql(),
    "ing_temporal": f"""select no, try_cast(if(regexp_matches(w, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'), w, null) as date) as day, strftime(try_cast(if(regexp_matches(w, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T'), replace(w, 'Z', ''), null) as timestamp), '%Y-%m-%d %H:%M:%S') as instant,
        if(try_cast(replace(w, 'Z', '') as timestamp) is null, v, null) as text from (select no, v, trim(v) as w from (select no, {_SAID} as v from invoice_header))""",
    "ing_names": f"""with raw as (select p_partkey, {_RAW_NAME} as v from part), bare as (select p_partkey, trim(regexp_replace(v, '[^0-9A-Za-z_]+', '_', 'g'), '_') as b from raw),
        named as (select p_partkey, case when b = '' then 'field' when regexp_matches(b, '^[0-9]') then 'f_' || b else b end as x from bare)
        select p_partkey, left(if(lower(x) in ({', '.join(repr(w) for w in n.RESERVED)}), x || '_field', x), 63) as column_name from named""",
    "ing_repair": """select count(*) filter (bad) as corrupt_before, count(*) filter (bad and (k % 3 = 0 or k % 2 = 1)) as corrupt_after from (select k, coalesce(contains(external_no, '\ufffd'), false) as bad from invoice_header)""",
    "mrg_changes": f"select count(*) filter (a = 'insert') as inserted, count(*) filter (a = 'update') as updated, count(*) filter (a = 'keep') as kept from (select {_ACTION} as a from {_BOTH})",
    "ing_flatten": """select no as "No", location_code as "Address_City", state_dim as "Address_Dim_state_dim", '["' || bill_state || '",' || coalesce('"' || ship_state || '"', 'null') || ']' as "States", cast(amount as varchar) as "f_2nd_amount" from invoice_header""",
    "mrg_upsert": f"""select coalesce(o.no, n.no) as no, if(n.no is null, o.customer_no, n.customer_no) as customer_no, if(n.no is null, o.posting_date, n.posting_date) as posting_date, round(cast(if(n.no is null, o.amount, n.amount) as double), 4) as amount, o.own_note, n.eway_no,
        if({_ACTION} = 'keep', timestamp '1999-01-01', timestamp '2000-01-01') as _synced_at from {_BOTH}""",
    "mrg_skip_unchanged": f"select {_ACTION} as action, count(*) as n_rows from {_BOTH} group by 1",
    "mrg_invalid_keys": "select no, ship_to_code, external_no, 'missing or blank key' as reason from invoice_header where external_no is null or coalesce(trim(ship_to_code), '') = ''",
    "mrg_dup_keys": "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1",
    "mrg_last_wins": "select customer_no, arg_max(no, (posting_date, no)) as no, max(posting_date) as posting_date from invoice_header group by 1",
    "mrg_rekey_check": f"{_LINES} having count(*) > 1",
}
ORACLE_SQL = {}
for _name, _sql in _ASK.items():
    if _name in ("ing_names", "ing_table_names"):
        ORACLE_SQL[_name] = _sql
    elif _name == "ing_windows":
        _full = with_tables("select 1 from invoice_header").rsplit("\n", 1)[0]
        ORACLE_SQL[_name] = f"{_full},\n{_sql.removeprefix('with ')}"
    else:
        ORACLE_SQL[_name] = with_tables(_sql, _STEPS)
