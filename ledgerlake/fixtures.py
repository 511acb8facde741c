"""Ledger tables derived from the star-schema test tables.

Each rule is one SQL text that Spark and DuckDB read alike; k is the order key, c the customer key, s the line's number in its order. Nulls, blanks, dirt
and duplicates come from key arithmetic.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .plans.stages import stage_once

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

BRANCH = "case k % 4 when 0 then 'AHD' when 1 then 'BLR' when 2 then 'HYD' else 'MUM' end"
INVOICE_NO = f"cast(cast(27 + floor(k / 100000) as int) as string) || {BRANCH} || '-' || lpad(cast(k % 100000 as string), 5, '0')"
MEMO_NO = f"cast(cast(27 + floor(k / 100000) as int) as string) || 'CN' || {BRANCH} || '-' || lpad(cast(k % 100000 as string), 5, '0')"
PO = """case when k % 17 = 0 then '' else (case when c % 3 = 0 then 'PO' || cast(k as string) else 'PO' || cast(c as string) || '-' || cast(year(d) as string) end)
     || (case when k % 11 = 0 then '-A' when k % 13 = 0 then '.' when k % 19 = 0 then '�' else '' end) end"""


def padded(key: str, width: int) -> str:
    """A key as text with zeros in front up to width; longer keys stay whole, so that no two share a code."""
    return f"lpad(cast({key} as string), cast(greatest({width}, length(cast({key} as string))) as int), '0')"


ITEM = f"'FG/' || {padded('p', 6)}"

TABLES = {
    "order_base": "select o_orderkey as k, o_custkey as c, cast(o_orderdate as date) as d, o_orderstatus as st, cast(o_totalprice as decimal(18,4)) as total from orders",
    "line_base": """
        select l_orderkey as k, l_partkey as p, cast(l_quantity as decimal(18,4)) as q, cast(l_discount as decimal(18,4)) as disc, l_returnflag as rf, cast(l_shipdate as date) as ship,
               row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as s
        from lineitem""",
    "gst_state": """
        select 'S' || lpad(cast(n_nationkey as string), 2, '0') as state_code, lpad(cast(n_nationkey + 1 as string), 2, '0') as state_no, n_name as state_name,
               lpad(cast(n_nationkey + 1 as string), 2, '0') || '-' || n_name as label from nation""",
    "invoice_header": f"""
        select {INVOICE_NO} as no, k, 'C' || {padded('c', 5)} as customer_no, 'Customer ' || cast(c as string) as customer_name,
               case when k % 3 = 0 then 'ST' || cast(k % 7 as string) when k % 3 = 1 then '' end as ship_to_code, case when k % 5 = 0 then '' else 'SO' || cast(k as string) end as order_no,
               {PO} as external_no, d as posting_date, d as document_date, case when k % 10 = 3 then true when k % 10 = 7 then cast(null as boolean) else false end as cancelled,
               {BRANCH} as location_code, case when k % 6 = 0 then 'Taxable' else 'Bill of Supply' end as invoice_type, case when k % 8 <> 0 then 'irn' || cast(k as string) end as irn,
               case when k % 9 = 0 then 'EW' || cast(k as string) end as eway_no, case when k % 4 = 0 then 'Shop ? ' || cast(c as string) when k % 4 = 1 then 'Shop ' || cast(c as string) end as ship_to_name,
               case when k % 12 = 0 then cast(null as string) else 'Registered' end as gst_customer_type, 'S' || lpad(cast(c % 25 as string), 2, '0') as bill_state,
               case when k % 29 = 0 then cast(null as string) else 'S' || lpad(cast((c + k % 2) % 25 as string), 2, '0') end as ship_state, 'S' || lpad(cast((k % 4) * 3 as string), 2, '0') as location_state,
               case when k % 5 = 1 then 'B2B' end as nature, case when k % 31 = 0 then 'USD' end as currency, k % 23 = 0 as without_duty, case when k % 23 = 0 then 'BE' || cast(k as string) end as export_no,
               case when k % 2 = 0 then date '0001-01-01' else d end as export_date, case when k % 21 = 0 then 'EC1' end as ecom_customer, case when k % 21 = 0 then 'M1' end as ecom_merchant,
               'D1-' || cast(c % 4 as string) as state_dim, case when k % 7 = 0 then 'BU' || cast(k % 3 as string) end as bu_dim, total as amount
        from order_base""",
    "invoice_line": f"""
        select {INVOICE_NO} as document_no, b.k, b.s, cast(10000 * b.s as string) as line_no, case when b.s = 7 then 'G/L Account' else 'Item' end as type, {ITEM} as no,
               case when b.s = 7 and b.k % 2 = 0 then {ITEM} else '' end as item_no, 'Line ' || cast(b.p as string) as description, {BRANCH} as location_code, case when b.p % 5 = 0 then cast(null as string) else 'PCS' end as uom,
               case when (b.k + b.s) % 50 = 0 then cast(0 as decimal(18,4)) else b.q end as quantity, cast(t.p_retailprice as decimal(18,4)) as unit_price, cast(100 * b.disc as decimal(18,4)) as discount_percent,
               cast(round(cast(b.q * cast(t.p_retailprice as decimal(18,4)) as decimal(18,4)) * b.disc, 2) as decimal(18,4)) as discount_amount,
               cast(round(cast(b.q * cast(t.p_retailprice as decimal(18,4)) as decimal(18,4)) * (1 - b.disc), 2) as decimal(18,4)) as line_amount,
               cast(b.q + b.s % 3 as decimal(18,4)) as po_quantity, case when b.k % 6 = 0 then '' else 'PO' || cast(b.k as string) end as po_no
        from line_base b join part t on t.p_partkey = b.p""",
    "memo_header": f"""
        select {MEMO_NO} as no, k, 'C' || {padded('c', 5)} as customer_no, 'Customer ' || cast(c as string) as customer_name, d + cast(k % 5 as int) as posting_date,
               case when k % 16 = 5 then cast(null as date) else d + cast(k % 45 as int) end as document_date, k % 20 = 9 as corrective, k % 20 = 13 as correction,
               case cast(floor(k / 4) as int) % 6 when 0 then 'SHGRN' when 1 then 'EXP' when 2 then 'DMG' when 3 then 'INC' when 4 then 'FR' else (case when k % 5 = 0 then 'CAPPING RT' else 'RECO-CN' end) end as reason,
               case when k % 8 = 1 then {INVOICE_NO} else '' end as applies_to_no, case when k % 8 = 1 then 'Invoice' else ' ' end as applies_to_type,
               case when k % 3 = 0 then {INVOICE_NO} || '/R' when k % 3 = 1 then {PO} else '' end as external_no, case when k % 7 = 0 then 'PRN-' || cast(k as string) when k % 7 = 1 then {INVOICE_NO} end as prn_no,
               {BRANCH} as location_code, 'Taxable' as invoice_type, 'S' || lpad(cast(c % 25 as string), 2, '0') as bill_state, 'S' || lpad(cast((c + 1) % 25 as string), 2, '0') as ship_state,
               'S' || lpad(cast((k % 4) * 3 as string), 2, '0') as location_state, case when k % 9 = 1 then 'LOCREG' end as location_reg_no, case when k % 9 = 2 then 'SHIPREG' end as ship_reg_no,
               cast(total * cast(0.1 as decimal(4,2)) as decimal(18,4)) as amount
        from order_base where k % 4 = 1""",
    "memo_line": f"""
        select {MEMO_NO} as document_no, b.k, b.s, cast(10000 * b.s as string) as line_no, case when b.s = 6 then 'G/L Account' else 'Item' end as type, {ITEM} as no, case when b.s % 2 = 0 then {ITEM} else '' end as item_no,
               'Return ' || cast(b.p as string) as description, {BRANCH} as location_code, 'PCS' as uom, case when b.k % 3 = 0 then cast(1 as decimal(18,4)) else b.q end as quantity, cast(t.p_retailprice as decimal(18,4)) as unit_price,
               cast(0 as decimal(18,4)) as discount_percent, cast(0 as decimal(18,4)) as discount_amount, cast(b.q * cast(t.p_retailprice as decimal(18,4)) as decimal(18,4)) as line_amount,
               case when b.s % 3 = 0 then 'R' || cast(b.s as string) else '' end as return_reason, case when b.k % 2 = 0 then 'ST1' end as ship_to_code
        from line_base b join part t on t.p_partkey = b.p where b.rf = 'R' and b.k % 4 = 1""",
    "component": "select 1 as n union all select 2 as n",
    "tax_entry": """
        select l.document_no, l.k * 1000 + l.s * 10 + n.n as entry_no, 10000 * l.s as line_no, 'Invoice' as document_type, case when l.k % 37 = 0 then 'Purchase' else 'Sales' end as transaction_type,
               case when l.k % 31 = 0 then true when l.k % 3 = 0 then cast(null as boolean) else false end as reversed,
               case when h.ship_state = h.location_state then (case n.n when 1 then 'CGST' else 'SGST' end) else 'IGST' end as component,
               cast(-round(l.line_amount * cast(case when h.ship_state = h.location_state then 0.09 else 0.18 end as decimal(4,2)), 2) as decimal(18,4)) as amount,
               cast(case when h.ship_state = h.location_state then 9 else 18 end as decimal(18,4)) as percent, -l.line_amount as base_amount, case when l.s % 4 <> 0 then 'HSN' || cast(l.k % 13 as string) end as hsn,
               case when l.s % 5 <> 0 then 'GRP' || cast(l.k % 5 as string) end as group_code, case when l.s % 2 = 0 then 'Goods' end as group_type, case when l.s % 3 = 0 then cast(null as string) when h.ship_state = h.location_state then 'Intrastate' else 'Interstate' end as jurisdiction,
               case l.s % 4 when 0 then cast(null as string) when 1 then 'Ship-to Address' when 2 then 'Bill-to Address' else 'Location Address' end as supply_place, case when l.k % 5 <> 0 then 'CO' || h.location_code end as location_reg_no,
               case when l.k % 6 = 0 then '' else lpad(cast(cast(substring(h.bill_state, 2, 2) as int) + 1 as string), 2, '0') || 'REG' || cast(l.k % 3 as string) end as party_reg_no, h.customer_no as source_no, h.posting_date
        from invoice_line l join invoice_header h on h.no = l.document_no cross join component n
        where (l.k + l.s) % 9 <> 0 and (n.n = 1 or h.ship_state = h.location_state)
        union all
        select l.document_no, l.k * 1000 + l.s * 10 + 5, 10000 * l.s, 'Credit Memo', 'Sales', false, 'IGST', cast(round(l.line_amount * cast(0.18 as decimal(4,2)), 2) as decimal(18,4)), cast(18 as decimal(18,4)), l.line_amount, 'HSN', 'GRP', 'Goods', 'Interstate',
               'Ship-to Address', 'COX', '', h.customer_no, h.posting_date
        from memo_line l join memo_header h on h.no = l.document_no where l.s % 3 = 0""",
    "value_entry": """
        select l.k * 1000 + l.s * 10 + n.n as entry_no, l.document_no, 10000 * l.s as line_no, cast(-l.line_amount * cast(case when l.s % 2 = 0 then 0.6 else 0.3 end as decimal(4,2)) as decimal(18,4)) as cost, l.k * 100 + l.s as item_entry_no, case when l.s = 5 then 'Transfer' else 'Sale' end as entry_type
        from invoice_line l cross join component n where n.n <= 1 + l.s % 2
        union all
        select l.k * 1000 + l.s * 10 + 9, l.document_no, 10000 * l.s, cast(l.line_amount * cast(0.6 as decimal(4,2)) as decimal(18,4)), l.k * 100 + l.s, 'Sale' from memo_line l""",
    "item_ledger": "select cast(b.k * 100 + b.s as string) as entry_no, cast(round(cast(t.p_retailprice as decimal(18,4)), 0) as decimal(18,4)) as mrp, b.ship as posting_date from line_base b join part t on t.p_partkey = b.p where (b.k + b.s) % 6 <> 0",
    "item_card": f"select 'FG/' || {padded('p_partkey', 6)} as no, case when p_partkey % 3 <> 0 then 'IH' || cast(p_partkey % 9 as string) end as hsn, 'IG' || cast(p_partkey % 4 as string) as group_code, p_name as description, p_type as category from part where p_partkey % 10 <> 9",
    "api_item": f"select 'FG/' || {padded('p_partkey', 6)} as number, case when p_partkey % 8 <> 0 then p_name || ' ' || p_brand end as display_name from part where p_partkey % 7 <> 0",
    "customer_card": f"""
        select 'C' || {padded('c_custkey', 5)} as no, case when c_custkey % 9 <> 0 then c_name end as name, 'S' || cast(c_custkey as string) as search_name, case when c_custkey % 4 = 0 then cast(null as string) else 'Registered' end as registration_type,
               c_custkey % 6 = 0 as ecom_operator, c_mktsegment as posting_group from customer where c_custkey % 11 <> 0""",
    "ship_address": f"""
        select 'C' || {padded('c_custkey', 5)} as customer_no, 'ST' || cast(c_custkey % 7 as string) as code, 'Ship ' || cast(c_custkey as string) as name,
               case when c_custkey % 3 = 0 then '' else 'SHIPGST' || cast(c_custkey as string) end as registration_no from customer""",
    "site": "select 'ST' || cast(n_nationkey as string) as code, 'Site ' || n_name as name from nation where n_nationkey < 6",
    "customer_ref": f"""
        select 'C' || {padded('c_custkey', 5)} as customer_no, c_name as customer_name, 'S' || cast(c_custkey as string) as search_name,
               case c_custkey % 5 when 0 then 'Blinkit' when 1 then 'Zepto' when 2 then 'Amazon' when 3 then 'BigBasket' end as platform, case when c_custkey % 4 = 0 then 'OLD' else c_mktsegment end as channel,
               case when c_custkey % 3 = 0 then 'ONE_PO_MANY_INVOICES' when c_custkey % 3 = 1 then 'ONE_PO_ONE_INVOICE' end as po_pattern, case when c_custkey % 4 <> 3 then 'feed' || cast(c_custkey % 4 as string) end as grn_feed,
               case when c_custkey % 2 = 0 then 'by_number' else 'by_po' end as match_rule, case when c_custkey % 6 = 0 then 'note' end as note, c_custkey % 7 = 0 as reviewed, date '2001-01-01' + cast(c_custkey % 400 as int) as updated_at
        from customer where c_custkey % 10 <> 0""",
    "channel_map": f"select 'C' || {padded('c_custkey', 5)} as customer_no, case c_custkey % 5 when 0 then 'Blinkit' when 1 then 'Zepto' when 2 then 'Flipkart Quick' else 'BigBasket' end as platform from customer where c_custkey % 5 < 4",
    "channel_site": f"select 'C' || {padded('c_custkey', 5)} as customer_no, 'ST' || cast(c_custkey % 7 as string) as ship_to_code, 'Store' as platform from customer where c_custkey % 4 = 0",
    "item_rename": f"select 'FG/' || {padded('p_partkey', 6)} as old_no, 'TG/' || {padded('p_partkey', 6)} as new_no from part where p_partkey % 20 = 0",
    "item_map": f"select 'Any' as platform, 'SKU' || cast(p_partkey as string) as sku, case when p_partkey % 50 = 0 then cast(null as string) else 'FG/' || {padded('p_partkey', 6)} end as item_no from part where p_partkey % 25 <> 1",
    "receipt": f"""
        select 'feed' || cast(k % 4 as string) as feed, k * 10 + s as id, 'Blinkit' as platform, case when k % 23 = 0 then 'C99999' else 'C' || {padded('c', 5)} end as customer, case when k % 8 in (0, 1, 3, 4, 5, 6) then {PO} else '' end as po,
               case k % 8 when 0 then {INVOICE_NO} when 1 then '27 ' || {BRANCH} || '-0' || cast(k % 100000 as string) when 2 then {INVOICE_NO} || '/A' when 3 then {INVOICE_NO} || ', X' || cast(k as string)
                          when 4 then lpad(cast(k % 100000 as string), 5, '0') when 6 then lower({INVOICE_NO}) || ' and 27AHD-00004' end as inv,
               case when k % 3 = 0 then 'G' || cast(k as string) end as grn_no, case when k % 7 = 0 then cast(null as date) when k % 41 = 0 then d + (-365) else d + cast(k % 9 as int) end as grn_date,
               case when s % 5 = 0 then cast(null as string) else 'sku' || cast(p as string) end as feed_item_code, 'Any' as map_platform, case when k % 43 = 0 then cast(null as decimal(18,4)) else cast(q - (case when p % 7 = 0 then 1 else 0 end) as decimal(18,4)) end as received_qty,
               q as ordered_qty, case when p % 7 = 0 then cast(1 as decimal(18,4)) end as rejected_qty, case when k % 43 = 0 then 'grn pending (OPEN)' when p % 7 = 0 then 'short' end as reject_reason, 'file' || cast(k % 5 as string) as source_file
        from (select b.k, b.s, b.p, b.q, o.c, o.d from line_base b join order_base o on o.k = b.k where b.s <= 3
              union all select b.k, b.s + 5, b.p, b.q, o.c, o.d from line_base b join order_base o on o.k = b.k where b.s = 1 and b.k % 37 = 0) x""",
}


def needs(sql: str) -> list[str]:
    """Fixture tables that a text mentions, with those that they are made of, in the order of TABLES."""
    found: set[str] = set()

    def add(text: str) -> None:
        for word in set(re.findall(r"\w+", text)) & TABLES.keys() - found:
            found.add(word)
            add(TABLES[word])

    add(sql)
    return [t for t in TABLES if t in found]


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """sql behind a WITH of the fixtures (and of extra named steps) that it needs; what DuckDB is asked."""
    steps, order = dict(extra or {}), []

    def add(text: str) -> None:
        for word in re.findall(r"(?:from|join)\s+(\w+)", text):
            if word in steps and word not in order:
                add(steps[word])
                order.append(word)

    add(sql)
    tables = needs(sql + " ".join(steps[s] for s in order))
    return "with " + ",\n".join([f"{t} as ({TABLES[t]})" for t in tables] + [f"{s} as ({steps[s]})" for s in order]) + f"\n{sql}" if tables or order else sql


# Derived with joins or windows, or from wide rows, and read by many queries: written once in an application.
WRITTEN = ("line_base", "invoice_header", "invoice_line", "memo_header", "memo_line", "tax_entry", "value_entry", "item_ledger", "receipt")


def bases(name: str) -> list[str]:
    """The test tables that a fixture is made of."""
    texts = [TABLES[t] for t in needs(name)]
    return [b for b in BASE if any(re.search(rf"(?:from|join) {b}\b", x) for x in texts)]


def fixture(spark: SparkSession, sf_dir: str, name: str, written: bool | tuple[str, ...] = True) -> DataFrame:
    """One fixture table over the parquet tables of sf_dir. written: large ones (or those named) are written first, for plans that read them several times;
    without, a plan that reads a few columns once derives those columns only."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    names = [x for x in (*BASE, *TABLES) if x != name and re.search(rf"(?:from|join) {x}\b", TABLES[name])]
    sql = re.sub(rf"(?<=from |join )({'|'.join(names)})\b", r"{\1}", TABLES[name]) if names else TABLES[name]

    def build() -> DataFrame:
        return spark.sql(sql, **{x: fixture(spark, sf_dir, x, written) for x in names})

    if name not in (WRITTEN if written is True else written or ()):
        return build()
    return stage_once(spark, name, build, sf_dir, inputs=tuple(f"{sf_dir}/{x}.parquet" for x in bases(name)))


class Tables:
    """Fixture tables by attribute, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, written: bool | tuple[str, ...] = True):
        self._at, self._written = (spark, sf_dir), written

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = fixture(*self._at, name, self._written)
        setattr(self, name, df)
        return df
