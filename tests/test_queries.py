"""Every registered query of the catalogue against its SQL on the smallest tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from ledgerlake import queries

SF = "/root/testdata/sf0.001"
QUICK = ["reg_full", "reg_monthly_totals", "reg_reconcile", "o2c_hdr", "o2c_match", "o2c_feed_match", "o2c_invoices", "ing_windows", "ing_infer", "ing_temporal", "ing_names", "run_backfill", "run_state", "run_set_aside", "src_pages", "src_xml", "o2c_feeds", "mrg_upsert", "quota_check", "ref_platform_follow", "lin_dependents", "str_available_now_upsert", "src_pushdown", "src_chain_order", "mrg_later_page", "run_resume_state", "run_series", "run_open", "mrg_partial", "ing_open_guard", "str_series_high", "str_gaps", "lin_cycles", "reg_bucketed", "run_raw", "ing_widen", "mrg_preserve", "ing_table_names"]


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return str(round(float(v), 4) + 0.0) if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else str(v)[:19]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert ours == theirs


def test_catalogue_has_sql_for_each_query():
    assert queries.QUERIES.keys() == queries.ORACLE_SQL.keys()
