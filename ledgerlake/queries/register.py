"""Queries over the sales register and its steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import BASE, Tables, with_tables
from ..plans import ledger_store as store
from ..plans import register as r
from ..plans.stages import stage_once
from .common import money, settled

STEPS = {
    "tax_live": "select * from tax_entry where transaction_type = 'Sales' and reversed is distinct from true",
    "tax_posted": "select * from tax_live where document_type in ('Invoice', 'Credit Memo')",
    "tax_component": "select document_no as doc_no, line_no, component, sum(amount) as amount, max(percent) as percent from tax_posted group by all",
    "tax_line": """select document_no as doc_no, line_no, max(document_type) as doc_type, max(hsn) as hsn, max(group_code) as group_code, max(group_type) as group_type, max(jurisdiction) as jurisdiction,
                          max(supply_place) as supply_place, max(location_reg_no) as company_reg, max(party_reg_no) as party_reg, -max(base_amount) as base_amount from tax_posted group by all""",
    "tax_pivot": """select l.*, p.igst, p.cgst, p.sgst, p.tax_percent from tax_line l join (
                      select doc_no, line_no, coalesce(-sum(amount) filter (component = 'IGST'), 0) as igst, coalesce(-sum(amount) filter (component = 'CGST'), 0) as cgst,
                             coalesce(-sum(amount) filter (component = 'SGST'), 0) as sgst, coalesce(sum(percent), 0) as tax_percent from tax_component group by all) p using (doc_no, line_no)""",
    "doc_fallback": "select document_no as doc_no, max(location_reg_no) as company_reg, max(party_reg_no) as party_reg, max(supply_place) as supply_place, max(jurisdiction) as jurisdiction from tax_live group by all",
    "customer_reg": """select customer_no, state_no, reg from (
                         select source_no as customer_no, party_reg_no[1:2] as state_no, party_reg_no as reg, row_number() over (partition by source_no, party_reg_no[1:2] order by count(*) desc, party_reg_no) as place
                         from tax_entry where transaction_type = 'Sales' and party_reg_no <> '' group by source_no, party_reg_no) where place = 1""",
    "location_reg": """select location_code, company_reg from (
                         select h.location_code, f.company_reg, row_number() over (partition by h.location_code order by count(*) desc, f.company_reg) as place
                         from invoice_header h join doc_fallback f on f.doc_no = h.no where f.company_reg is not null and h.location_code is not null group by 1, 2) where place = 1""",
    "line_cost": "select v.document_no as doc_no, v.line_no, sum(v.cost) as cost, max(i.mrp) as mrp from value_entry v left join item_ledger i on i.entry_no = cast(v.item_entry_no as varchar) where v.entry_type = 'Sale' group by all",
    "documents": """
        select 'Invoice' as document_type, h.no as doc_no, try_cast(l.line_no as decimal(18,4)) as line_no, h.location_code as company_location, h.invoice_type, cast(null as varchar) as return_reason, h.cancelled, h.irn, h.eway_no,
               h.posting_date, h.document_date as invoice_date, h.customer_no, h.customer_name, h.gst_customer_type, h.ship_to_code, h.ship_to_name, h.bill_state, h.ship_state, h.location_state, h.nature, h.currency, h.without_duty,
               h.export_no, h.export_date, h.ecom_customer, h.ecom_merchant, h.state_dim, h.bu_dim, cast(null as varchar) as prn_no, h.external_no, l.type as line_type, l.no as account_no, l.item_no, l.description, l.location_code, l.uom,
               l.quantity, l.unit_price, l.discount_percent, l.discount_amount, l.line_amount, cast(null as varchar) as location_reg_no, cast(null as varchar) as ship_reg_no,
               l.no as printed_item, if(l.type = 'Item', l.no, nullif(l.item_no, '')) as lookup_item
        from invoice_line l join invoice_header h on h.no = l.document_no where l.quantity <> 0
        union all by name
        select 'Credit Memo' as document_type, h.no as doc_no, try_cast(l.line_no as decimal(18,4)) as line_no, h.location_code as company_location, h.invoice_type, coalesce(nullif(l.return_reason, ''), h.reason) as return_reason, h.corrective as cancelled,
               h.posting_date, h.customer_no, h.customer_name, l.ship_to_code, h.bill_state, h.ship_state, h.location_state, h.prn_no, h.external_no, l.type as line_type, l.no as account_no, l.item_no, l.description, l.location_code, l.uom,
               -l.quantity as quantity, l.unit_price, l.discount_percent, -l.discount_amount as discount_amount, -l.line_amount as line_amount, h.location_reg_no, h.ship_reg_no,
               if(l.type = 'Item', l.no, coalesce(l.item_no, '')) as printed_item, if(l.type = 'Item', l.no, nullif(l.item_no, '')) as lookup_item
        from memo_line l join memo_header h on h.no = l.document_no where l.quantity <> 0""",
    "priced": """
        select d.*, c.cost, case when d.line_type <> 'Item' then 0
                         when d.discount_percent <> 0 and d.quantity <> 0 then cast((2 * cast(d.discount_amount * 10000 as hugeint) * 1000000 + cast(d.discount_percent * 10000 as hugeint) * cast(d.quantity * 10000 as hugeint)) // (2 * cast(d.discount_percent * 10000 as hugeint) * cast(d.quantity * 10000 as hugeint)) as decimal(18,4))
                         when c.mrp <> 0 then c.mrp else round(coalesce(d.unit_price, 0), 0) end as list_price
        from documents d left join line_cost c on c.doc_no = d.doc_no and c.line_no = d.line_no""",
    "reg": f"""
        select d.company_location, coalesce(g.company_reg, f.company_reg, d.location_reg_no, lr.company_reg, '') as company_gstin, d.document_type, d.invoice_type, coalesce(d.return_reason, '') as return_reason_code, d.doc_no as document_no,
               if(d.cancelled, 'Yes', 'No') as cancelled, '' as transfer_order_no, coalesce(d.irn, '') as irn_no, coalesce(d.eway_no, '') as e_way_bill_no, d.posting_date, d.invoice_date, d.customer_no as customer_code,
               coalesce(cc.name, d.customer_name) as name, coalesce(sh.label, bl.label, lo.label, d.ship_state, d.bill_state, '') as customer_state,
               case when coalesce(g.party_reg, '')[1:2] = sh.state_no then g.party_reg when sa.registration_no <> '' then sa.registration_no when g.doc_no is not null and coalesce(g.party_reg, '') = '' then ''
                    else coalesce(cr.reg, d.ship_reg_no, g.party_reg, f.party_reg, '') end as gstn,
               coalesce(d.gst_customer_type, '') as gst_customer_type, coalesce(cc.registration_type, '') as gst_registration_type, if(cc.ecom_operator, 'Yes', 'No') as e_commerce_operator, coalesce(d.ship_to_code, '') as ship_to_address_code,
               replace(coalesce(d.ship_to_name, ''), '?', '–') as ship_to_name, coalesce(bl.label, d.bill_state, '') as gst_bill_to_state, coalesce(sh.label, d.ship_state, '') as gst_ship_to_state, coalesce(d.nature, '') as nature_of_supply,
               coalesce(g.supply_place, if(coalesce(d.ship_state, '') = '', 'Bill-to Address', 'Ship-to Address')) as gst_place_of_supply,
               case gst_place_of_supply when 'Ship-to Address' then coalesce(sh.label, d.ship_state) when 'Bill-to Address' then coalesce(bl.label, d.bill_state) else coalesce(lo.label, d.location_state) end as gst_state,
               d.line_type as type, d.printed_item as item_account, '' as varient, '' as colour, '' as size, '' as barcode, if(d.lookup_item is null, '', coalesce(im.display_name, d.description, '')) as description, '' as category, '' as sub_category,
               '' as season_code, coalesce(d.location_code, '') as location_code, coalesce(d.uom, '') as unit_of_measure, coalesce(d.currency, '') as currency_code, {money("d.quantity")}, 0.0::double as rate_fcy,
               cast(round(d.unit_price, 2) as double) as rate_lcy, 0.0::double as amount_fcy, cast(d.list_price as double) as mrp, round(abs(cast(d.quantity as double)) * cast(d.list_price as double), 2) as gmv,
               round(cast(d.line_amount + d.discount_amount as double), 4) as amount_lcy, {money("d.discount_percent")}, round(cast(d.discount_amount as double), 4) as discount,
               coalesce(g.group_code, if(d.lookup_item is null, null, ic.group_code), '') as gst_group_code, coalesce(g.hsn, if(d.lookup_item is null, null, ic.hsn), '') as gst_hsn_sac, cast(coalesce(g.tax_percent, 0) as double) as gst_percent,
               coalesce(g.group_type, 'Goods') as gst_group_type, coalesce(g.jurisdiction, f.jurisdiction, if(coalesce(d.ship_state, d.location_state) = d.location_state, 'Intrastate', 'Interstate')) as gst_jurisdiction_type,
               round(cast(d.line_amount as double), 4) as gst_base_amount, round(cast(coalesce(g.igst, 0) as double), 4) as igst, round(cast(coalesce(g.cgst, 0) as double), 4) as cgst, round(cast(coalesce(g.sgst, 0) as double), 4) as sgst, 0.0::double as tcs_amount,
               cast(round(d.line_amount + coalesce(g.igst, 0) + coalesce(g.cgst, 0) + coalesce(g.sgst, 0), 2) as double) as amount_to_customer, round(cast(coalesce(if(d.document_type = 'Invoice', -d.cost, d.cost), 0) as double), 4) as cogs,
               if(d.without_duty, 'Yes', 'No') as gst_without_payment_of_duty, coalesce(d.export_no, '') as bill_of_export_no, nullif(d.export_date, date '0001-01-01') as bill_of_export_date, coalesce(d.ecom_customer, '') as e_commerce_customer,
               coalesce(d.ecom_merchant, '') as e_commerce_merchant_id, 0.0::double as mrp_price, coalesce(d.state_dim, '') as state_code, coalesce(d.bu_dim, '') as bu_code, coalesce(d.prn_no, '') as prn_document_no,
               coalesce(d.external_no, '') as external_document_no, cast(d.line_no as double) as line_no
        from priced d
        left join tax_pivot g on g.doc_no = d.doc_no and g.line_no = d.line_no and g.doc_type = d.document_type
        left join doc_fallback f on f.doc_no = d.doc_no
        left join location_reg lr on lr.location_code = d.company_location
        left join item_card ic on ic.no = d.lookup_item
        left join api_item im on im.number = d.lookup_item
        left join ship_address sa on sa.customer_no = d.customer_no and sa.code = d.ship_to_code
        left join customer_card cc on cc.no = d.customer_no
        left join gst_state sh on sh.state_code = d.ship_state
        left join customer_reg cr on cr.customer_no = d.customer_no and cr.state_no = sh.state_no
        left join gst_state bl on bl.state_code = d.bill_state
        left join gst_state lo on lo.state_code = d.location_state""",
}


def _step(build, written=True):
    return lambda spark, sf_dir: settled(build(Tables(spark, sf_dir, written)))


def _register(spark, sf_dir, columns: list[str] | None = None):
    """The register's columns (None: all). Lines are written once; taxes too where several steps read them; the rest is read once and derives these columns
    only. What joins several grouped steps is written, which ends its shuffles; a reader's own would stand beside them."""
    steps = r.steps_of(columns)
    twice = ("tax_entry",) if len(steps & {"g", "gd", "lr", "cr"}) > 1 else ()

    def build():
        whole = r.register(Tables(spark, sf_dir, ("line_base", "invoice_line", *twice)), columns)
        return whole.select(*columns) if columns else whole

    return stage_once(spark, "register", build, sf_dir, ",".join(columns or ()), inputs=tuple(f"{sf_dir}/{b}.parquet" for b in BASE)) if len(steps) > 1 else build()


def _of(columns: list[str]):
    return lambda spark, sf_dir: settled(_register(spark, sf_dir, ["document_type", "document_no", "line_no", *columns]))


def _monthly(spark, sf_dir):
    month = F.date_format("posting_date", "yyyy-MM").alias("month")
    return settled(
        _register(spark, sf_dir, ["posting_date", "document_type", "quantity", "gst_base_amount", "igst", "cgst", "sgst", "amount_to_customer", "cogs"]).groupBy(month, "document_type").agg(F.count("*").alias("n_lines"), *[F.sum(c).alias(c) for c in ("quantity", "gst_base_amount", "igst", "cgst", "sgst", "amount_to_customer", "cogs")])
    )


def _reconcile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ours = r.documents(t.invoice_header, t.invoice_line, t.memo_header, t.memo_line).select("doc_no", "line_no", "document_type", "quantity", "line_amount", "uom")
    changed = F.when(F.col("line_amount") > 1000, F.col("line_amount") + 1).otherwise(F.col("line_amount"))
    theirs = ours.where("line_no <> 30000").withColumns({"line_amount": changed, "uom": F.coalesce("uom", F.lit("BOX"))})
    return r.reconcile(ours, theirs, ["document_type", "doc_no", "line_no"], ["quantity", "line_amount", "uom"])


GROUPS = {
    "reg_mrp_gmv": ["mrp", "gmv", "rate_lcy"],
    "reg_gstn": ["gstn", "company_gstin", "name"],
    "reg_supply_state": ["customer_state", "gst_bill_to_state", "gst_ship_to_state", "gst_place_of_supply", "gst_state"],
    "reg_hsn": ["gst_group_code", "gst_hsn_sac", "gst_percent", "gst_group_type", "gst_jurisdiction_type", "description"],
    "reg_amounts": ["amount_lcy", "gst_base_amount", "igst", "cgst", "sgst", "amount_to_customer", "cogs"],
}

def _bucketed(t):
    """Posted lines with their tax and cost, all three stored in buckets of document and line."""
    line = F.col("line_no").cast("int").alias("line_no")
    n = store.buckets_of(t.invoice_line.count())
    lines = store.store_bucketed(t.invoice_line.select("document_no", line, "line_amount"), "lines", buckets=n)
    taxes = store.store_bucketed(t.tax_entry.where("transaction_type = 'Sales' and document_type = 'Invoice' and not coalesce(reversed, false)").select("document_no", line, "amount"), "taxes", buckets=n)
    costs = store.store_bucketed(t.value_entry.select("document_no", line, "cost"), "costs", buckets=n)
    return store.line_totals(lines, taxes, costs)


QUERIES = {
    "reg_bucketed": lambda spark, sf_dir: settled(_bucketed(Tables(spark, sf_dir, written=("line_base", "invoice_line")))),
    "reg_full": lambda spark, sf_dir: settled(_register(spark, sf_dir)),
    "reg_tax_component": _step(lambda t: r.tax_component(t.tax_entry), written=False),
    "reg_tax_line": _step(lambda t: r.tax_line(t.tax_entry)),
    "reg_tax_pivot": _step(lambda t: r.tax_pivot(t.tax_entry).select("doc_no", "line_no", "doc_type", "igst", "cgst", "sgst", "tax_percent")),
    "reg_doc_fallback": _step(lambda t: r.doc_fallback(t.tax_entry), written=False),
    "reg_cust_modal_gstin": _step(lambda t: r.customer_reg(t.tax_entry), written=False),
    "reg_loc_modal_gstin": _step(lambda t: r.location_reg(t.invoice_header, t.tax_entry), written=False),
    "reg_cost": _step(lambda t: r.line_cost(t.value_entry, t.item_ledger)),
    "reg_doc_union": _step(lambda t: r.documents(t.invoice_header, t.invoice_line, t.memo_header, t.memo_line), written=False),
    "reg_monthly_totals": _monthly,
    "reg_reconcile": _reconcile,
    **{name: _of(columns) for name, columns in GROUPS.items()},
}

_MONEY = {"reg_tax_component": "* replace (round(cast(amount as double), 4) as amount, round(cast(percent as double), 4) as percent)", "reg_tax_line": "* replace (round(cast(base_amount as double), 4) as base_amount)",
          "reg_cost": f"* replace ({money('cost')}, {money('mrp')})",
          "reg_doc_union": "* replace (" + money("line_no", "quantity", "unit_price", "discount_percent", "discount_amount", "line_amount") + ")"}
_SOURCE = {"reg_full": "reg", "reg_tax_component": "tax_component", "reg_tax_line": "tax_line", "reg_doc_fallback": "doc_fallback", "reg_cust_modal_gstin": "customer_reg", "reg_loc_modal_gstin": "location_reg", "reg_cost": "line_cost", "reg_doc_union": "documents"}

ORACLE_SQL = {name: with_tables(f"select {_MONEY.get(name, '*')} from {step}", STEPS) for name, step in _SOURCE.items()}
ORACLE_SQL |= {name: with_tables(f"select document_type, document_no, line_no, {', '.join(columns)} from reg", STEPS) for name, columns in GROUPS.items()}
ORACLE_SQL["reg_tax_pivot"] = with_tables(f"select doc_no, line_no, doc_type, {money('igst', 'cgst', 'sgst', 'tax_percent')} from tax_pivot", STEPS)
ORACLE_SQL["reg_monthly_totals"] = with_tables(
    """select strftime(d.posting_date, '%Y-%m') as month, d.document_type, count(*) as n_lines, cast(sum(d.quantity) as double) as quantity, cast(sum(d.line_amount) as double) as gst_base_amount, cast(sum(coalesce(g.igst, 0)) as double) as igst,
       cast(sum(coalesce(g.cgst, 0)) as double) as cgst, cast(sum(coalesce(g.sgst, 0)) as double) as sgst, cast(sum(round(d.line_amount + coalesce(g.igst, 0) + coalesce(g.cgst, 0) + coalesce(g.sgst, 0), 2)) as double) as amount_to_customer,
       cast(sum(coalesce(if(d.document_type = 'Invoice', -d.cost, d.cost), 0)) as double) as cogs
       from priced d left join tax_pivot g on g.doc_no = d.doc_no and g.line_no = d.line_no and g.doc_type = d.document_type group by all""",
    STEPS,
)
ORACLE_SQL["reg_reconcile"] = with_tables(
    """select count(*) as ours, count(*) filter (line_no <> 30000) as theirs, count(*) filter (line_no = 30000) as only_ours, 0::bigint as only_theirs, 0::bigint as differ_quantity,
       count(*) filter (line_no <> 30000 and line_amount > 1000) as differ_line_amount, count(*) filter (line_no <> 30000 and uom is null) as differ_uom from documents""",
    STEPS,
)
ORACLE_SQL["reg_bucketed"] = with_tables(
    f"""select l.document_no, cast(l.line_no as integer) as line_no, {money('line_amount')}, round(cast(t.tax as double), 4) as tax, coalesce(t.n, 0) as tax_entries, round(cast(c.cost as double), 4) as cost
    from invoice_line l left join (select document_no, line_no, sum(amount) as tax, count(*) as n from tax_live where document_type = 'Invoice' group by all) t on t.document_no = l.document_no and t.line_no = cast(l.line_no as bigint)
    left join (select document_no, line_no, sum(cost) as cost from value_entry group by all) c on c.document_no = l.document_no and c.line_no = cast(l.line_no as bigint)""",
    STEPS,
)
