"""Sources and sinks: the fixtures are landed in the shared folder in the shape that a service sends, and read back."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import Tables, fixture, with_tables
from ..functions import normalize as n
from ..operators import merge as m
from ..plans import o2c
from ..plans.stages import shared_folder
from ..sources import chain as ch
from ..sources import pages as p
from ..sources import pushdown as z
from .common import money, settled

PAGE = 4000  # order numbers a page
RECORD = "struct<no:string,customer_no:string,posting_date:date,amount:decimal(18,4),k:bigint>"


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"


def _landed(t: Tables, spark: SparkSession) -> str:
    folder, page = f"{_folder(spark)}/pages", F.floor(F.col("k") / PAGE)
    rows = t.invoice_header.select("no", "customer_no", "posting_date", "amount", "k")
    p.land_pages(rows, page, folder, (page + 1).cast("string"))
    return folder


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of landed pages behind the service's own filter."""
    rows = p.read_pages(spark, _landed(Tables(spark, sf_dir), spark), "k % 3 = 0 or amount > 200000", RECORD)
    return settled(rows.select("no", "customer_no", "posting_date", "amount"))


def dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are named as the next one and have not landed."""
    return p.dangling_links(spark, _landed(Tables(spark, sf_dir), spark))


def _zoned(t: Tables, spark: SparkSession) -> str:
    """Invoices as pages of their month, up to 500 in a file, with a zone map of numbers and dates."""
    folder = f"{_folder(spark)}/zoned"
    rows = t.invoice_header.select("no", "customer_no", "posting_date", "amount", "k")
    z.land_zoned(rows, F.trunc("posting_date", "MM"), F.floor(F.col("k") / PAGE), folder, ["no", "posting_date"], F.floor(F.col("k") / (500 * PAGE)))
    return folder


def pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices of a range of days, by a source that opens the pages of that range only; the last condition is left to Spark."""
    rows = z.read_zoned(spark, _zoned(Tables(spark, sf_dir, written=False), spark), RECORD[7:-1].replace(":", " "))
    day = F.col("posting_date")
    found = rows.where((day >= F.lit(date(1996, 3, 10))) & (day < F.lit(date(1996, 7, 5))) & ~F.col("customer_no").isin("C00001", "C00004") & ((F.col("k") % 3 == 0) | (F.col("amount") > 200000)))
    return settled(found.select("no", "customer_no", "posting_date", "amount"))


def zone_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each month the pages (the pull's unit, whatever file they share), those that a pull by day and number opens, and the rows in them."""
    met = z.files_met(spark, _zoned(Tables(spark, sf_dir, written=False), spark), "greatest_posting_date >= date'1996-03-10' and least_posting_date < date'1996-07-05' and greatest_no >= '27HYD'")
    return met.groupBy("part").agg(F.count("*").alias("files"), F.count_if("met").alias("opened"), F.sum(F.when(F.col("met"), F.col("n")).otherwise(0)).alias("n_rows"))


CHAINED = 50  # order numbers of a page in the chains


def _chained(t: Tables, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(links of landed pages, their records). Names don't follow the order; there are chains that no request began, cycles, and pages named twice."""
    folder, g = f"{_folder(spark)}/chain", F.floor(F.col("k") / CHAINED)
    c, at = F.floor(g / 16), g % 16
    name = lambda n: F.lpad((n * 7919 % 1000003).cast("string"), 7, "0")
    link = F.when((at == 15) & (c % 11 == 10), c * 16 + 3).when((at == 15) & (c % 7 == 6), c * 16).when((at == 15) | ((at == 14) & (c % 11 == 10)), F.lit(None)).otherwise(g + 1)
    p.land_pages(t.invoice_header.select("no", "customer_no", "posting_date", "amount", "k"), name(g), folder, name(link))
    landed = p.page_links(spark, folder)
    asked = t.invoice_header.where((at == 0) & (c % 5 != 4)).select(name(g).alias("page"), F.lit(True).alias("first")).distinct()
    links = landed.select("page", F.col("`@odata.nextLink`").alias("next_link")).join(asked, "page", "left")
    records = p.read_pages(spark, folder, None, RECORD).withColumnRenamed("_page", "page")
    return links, records


def chain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each landed page along the links."""
    return ch.rank_pages(_chained(Tables(spark, sf_dir), spark)[0])


def chain_forks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that several pages name as the next."""
    return ch.forks(_chained(Tables(spark, sf_dir), spark)[0])


def later_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of each customer that came last, by the place of its page in its chain."""
    links, records = _chained(Tables(spark, sf_dir), spark)
    placed = records.join(ch.rank_pages(links).where("status = 'linked'"), "page")
    return m.last_wins(placed, ["customer_no"], ["chain", "place", "no"]).select("customer_no", "no", "chain", "place")


def xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses as XML rows; those without a registration number are no whole key."""
    folder = f"{_folder(spark)}/xml"
    rows = Tables(spark, sf_dir).ship_address.select(F.col("customer_no").alias("Customer_No"), F.col("code").alias("Code"), F.col("name").alias("Name"), F.col("registration_no").alias("GST_No"))
    rows.write.format("xml").option("rowTag", "ShipTo").option("rootTag", "List").save(folder)
    return p.read_xml(spark, folder, "ShipTo", {"Customer_No": "customer_no", "Code": "code", "GST_No": "registration_no"}, ["customer_no", "registration_no"])


ADDRESSES = 100  # a page


def xml_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the pull of address pages goes on after each page."""
    folder = f"{_folder(spark)}/xml-pages"
    rows = fixture(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / ADDRESSES).alias("page"), F.concat(F.lit("36;"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("Key"), F.col("c_name").alias("Name"))
    rows.repartition("page").write.format("xml").option("rowTag", "ShipTo").option("rootTag", "List").partitionBy("page").save(folder)
    return p.xml_progress(spark, folder, "ShipTo", "Key", ADDRESSES)


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same invoices as both endpoint families send them, each with the key of its family."""
    t, out = Tables(spark, sf_dir), []
    bare = t.invoice_header.select(F.col("no").alias("No"), F.col("customer_no").alias("Customer_No"), "k")
    camel = t.invoice_header.select(F.concat(F.lit("id-"), F.col("k").cast("string")).alias("id"), F.col("no").alias("number"), "k")
    for family, rows, schema in (("odata", bare, "struct<No:string,Customer_No:string>"), ("v2.0", camel, "struct<id:string,number:string>")):
        folder = f"{_folder(spark)}/family"
        p.land_pages(rows, F.floor(F.col("k") / PAGE), folder)
        out.append(p.read_family(spark, folder, family, ["Customer_No", "No"], schema).select(F.lit(family).alias("family"), F.col("_key").alias("key")))
    return out[0].unionByName(out[1])


def _services(t: Tables) -> DataFrame:
    """A registry with a service for each state; some switched off, some without a word on it."""
    state = t.gst_state
    no = F.col("state_no").cast("int")
    return state.select(F.concat(F.lit("Feed_"), "state_code").alias("name"), F.when(no % 4 == 0, F.lit(False)).when(no % 4 == 1, F.lit(True)).alias("enabled"), F.when(no % 2 == 0, "odata").otherwise("v2.0").alias("family"))


def chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enabled services of one endpoint family, chosen by name."""
    t = Tables(spark, sf_dir)
    services = _services(t)
    names = [r["name"] for r in p.registry(services).where("family = 'odata'").select("name").collect()]  # a registry has a few dozen rows
    return p.choose(services, names).select("name", "family", F.lit(True).alias("chosen"))


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that isn't there yet reads as an empty one; a batch is merged into it, written, and read again."""
    t, folder = Tables(spark, sf_dir), _folder(spark)
    batch = t.customer_card.select("no", "name", "posting_group")
    empty = p.read_keyed(spark, f"{folder}/table", batch.schema)
    m.merge(empty, batch, ["no"], F.lit("2000-01-01 00:00:00").cast("timestamp")).drop("_action").write.parquet(f"{folder}/table")
    return p.read_keyed(spark, f"{folder}/table", batch.schema).select(*batch.columns)


def side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalid and unfitting rows of a batch in the side table, as text."""
    t, folder = Tables(spark, sf_dir), f"{_folder(spark)}/side"
    rows = t.memo_header.select("no", "external_no", F.when(F.col("k") % 7 == 0, F.lit("x")).otherwise(F.col("amount").cast("string")).alias("amount"))
    good, bad = m.split_invalid(rows, ["external_no"])
    p.append_side(bad, folder, "memos")
    p.append_side(n.rejects(good, t.memo_header.select("no", "external_no", "amount").schema), folder, "memos")
    return spark.read.parquet(folder).select("table_name", "reason", F.get_json_object("row", "$.no").alias("no"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference table of states after some of its rows were sent anew."""
    state = Tables(spark, sf_dir).gst_state
    new = state.where("state_no > '20'").withColumn("state_name", F.upper("state_name")).unionByName(state.limit(0))
    return p.state_reference(p.state_reference(None, state), new)


# What each feed's rows take their columns from, in SQL over the derived receipts that both engines read; columns that a feed lacks are left out.
_REF = "case when inv is null then null else inv end"
_RAW = {
    "hot_grn": {"po_number": "po", "item_code": "feed_item_code", "quantity_grn": "received_qty", "quantity_po": "ordered_qty"},
    "hyperpure_grn": {"po_number": "po", "vendor_invoice_number": _REF, "grn_date": "grn_date", "product_no": "feed_item_code", "grn_qty": "received_qty", "qty_ordered": "ordered_qty", "damaged_qty": "rejected_qty"},
    "instamart_grn": {"po_number": "po", "invoice_no": _REF, "grn_no": "grn_no", "grn_date": "grn_date", "sku_code": "feed_item_code", "recv_qty": "received_qty", "exp_qty": "ordered_qty"},
    "milkbasket_grn": {"po_number": "po", "vendor_invoice_number": _REF, "grn_number": "grn_no", "grn_date": "grn_date", "article": "feed_item_code", "accepted_qty": "received_qty", "received_qty": "ordered_qty"},
    "reliance_grn": {"po_number": "po", "vendor_invoice_number": "inv || 'R'", "grn_number": "grn_no || 'R'", "grn_date": "grn_date", "shipping_address": "case when id % 3 = 0 then 'METRO hall' else 'other' end", "raw_data": "'{\"article\":\"' || coalesce(feed_item_code, '') || '\",\"accepted_qty\":\"' || cast(id % 9 as string) || '\",\"challan_qty\":\"' || cast(id % 11 as string) || '\"}'"},
    "nb_grn": {"po_no": "po", "invoice_no": _REF, "grn_no": "grn_no", "grn_date": "grn_date", "article_code": "feed_item_code", "accepted_quantity": "received_qty", "received_quantity": "ordered_qty", "rejected_quantity": "rejected_qty"},
    "mraws_grn": {"po_number": "po", "vendor_invoice_number": _REF, "grn_date": "grn_date", "sku": "feed_item_code", "rcv_qty": "received_qty", "ord_qty": "ordered_qty"},
    "mrgrn_grn": {"po_number": "po", "vendor_invoice_number": _REF, "grn_date": "grn_date", "sku": "feed_item_code", "rcv_qty": "received_qty", "ord_qty": "ordered_qty"},
    "bb_alert_grn": {"po_no": "po", "invoice_no": _REF, "grn_no": "grn_no", "grn_timestamp": "cast(grn_date as timestamp)", "sku_code": "feed_item_code", "accepted_quantity": "received_qty", "rejected_quantity": "rejected_qty", "rejected_reason": "case when id % 2 = 0 then '0' else 'torn' end"},
    "bb_net_grn": {"pono": "po", "invoiceno": _REF, "grnno": "grn_no", "invoicedate": "case when id % 5 = 0 then 'n/a' else cast(grn_date as string) end", "skucode": "feed_item_code", "quantity": "received_qty"},
    "flipkart_cb_grn": {"po_number": "po", "expected_delivery_date": "cast(grn_date as string)", "item_description": "feed_item_code", "grn_quantity": "received_qty", "po_quantity": "ordered_qty"},
    "flipkart_ppr_grn": {"supplier_invoice_number": "case when id % 2 = 0 then inv end", "invoice_number": _REF, "invoice_date": "cast(grn_date as string)", "description_of_goods": "feed_item_code", "quantity": "received_qty"},
    "fatema_grn": {"po_number": "po", "bill_no": "grn_no", "bill_date": "cast(grn_date as string)", "fsn_no": "case when id % 2 = 0 then feed_item_code end", "item_code": "'I' || cast(id as string)", "quantity": "received_qty"},
    "slveggies_grn": {"po_number": "po", "invoice_number": _REF, "bill_number": "grn_no", "bill_date": "cast(grn_date as string)", "fsn_number": "feed_item_code", "grn_quantity": "case when id % 2 = 0 then received_qty end", "received_quantity": "ordered_qty", "indent_quantity": "ordered_qty", "return_quantity": "rejected_qty"},
    "zepto_grn": {"po_no": "po", "sku": "feed_item_code", "status": "case id % 5 when 0 then 'COMPLETED' when 1 then 'PENDING_GRN' when 2 then 'CANCELLED' when 3 then 'ASN_CREATED' else 'OPEN' end", "grn_quantity": "case when id % 4 = 0 then null else received_qty end", "qty": "ordered_qty"},
    "amazon_grn": {"po_number": "po", "invoice_number": _REF, "invoice_date": "grn_date", "asin": "feed_item_code", "invoice_status": "case id % 3 when 0 then 'Closed' when 1 then 'Open' end", "received_quantity": "case when id % 4 = 0 then 0 else received_qty end", "invoice_quantity": "ordered_qty", "shortage_quantity": "rejected_qty", "has_shortage": "case when id % 5 = 0 then 'yes' end"},
    "flipkart_quick_grn": {"po_id": "po", "product_id": "feed_item_code", "received_quantity": "received_qty", "ordered_quantity": "ordered_qty", "rejected_quantity": "case when id % 3 = 0 then rejected_qty else 0 end", "po_item_status": "case id % 3 when 0 then 'CLOSED' when 1 then 'CANCELLED' else 'OPEN' end"},
}


def _share(feed: str) -> str:
    """Each feed has its own share of the derived receipts."""
    return f"id % {len(_RAW)} = {list(_RAW).index(feed)}"


def raw_feeds(t: Tables) -> dict[str, DataFrame]:
    """The seventeen receipt feeds in columns of their own."""
    return {name: t.receipt.where(_share(name)).selectExpr("id", *[f"{v} as {k}" for k, v in columns.items()], "source_file") for name, columns in _RAW.items()}


# Parquet keeps a repeated text once a file up to this many bytes of them, by default 1 MB; a list of a platform's customers passes that from some 130,000
# customers on, and would be written again in each of its rows.
DICTIONARY, LISTS = "parquet.dictionary.page.size", 128 << 20


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seventeen receipt feeds in one shape. A row holds all customers of its platform; where the session doesn't say how much repeated text a Parquet
    file keeps, it is told here, so that a sink writes each list once a file."""
    if spark.conf.get(DICTIONARY, None) is None:
        spark.conf.set(DICTIONARY, str(LISTS))
    t = Tables(spark, sf_dir, written=("line_base", "receipt"))
    return settled(o2c.receipt_feeds(raw_feeds(t), t.channel_map, separator=","))


def _feed_sql(feed: str) -> str:
    """The feed in the receipts' own columns: what its raw columns were made of, put back by hand where the feed has a rule."""
    spec, raw = o2c.FEEDS[feed], _RAW[feed]
    of = lambda name: f"({raw[spec[name]]})" if name in spec and spec[name] in raw else "null"
    col = {x: of(x) for x in ("po", "inv", "grn_no", "grn_date", "feed_item_code", "received_qty", "ordered_qty", "rejected_qty", "reject_reason")}
    listed = f"(select coalesce(string_agg(distinct customer_no, ',' order by customer_no), '') from channel_map where platform = '{spec['platform']}')"
    col |= {"platform": "'" + spec["platform"].replace("'", "''") + "'", "map_platform": "'" + spec.get("map_platform", spec["platform"]).replace("'", "''") + "'", "customer_nos": listed if spec["customers"] == "map" else f"'{','.join(spec['customers'])}'"}
    where = _share(feed)
    if feed == "hyperpure_grn":
        col["reject_reason"] = "if(rejected_qty > 0, 'damaged', null)"
    elif feed == "reliance_grn":
        have, sent = "(id % 9)", "(id % 11)"
        col |= {"platform": "if(id % 3 = 0, 'Metro', 'Reliance')", "customer_nos": "if(id % 3 = 0, 'C00356', 'C00035')", "feed_item_code": "coalesce(feed_item_code, '')", "received_qty": have, "ordered_qty": sent, "rejected_qty": f"nullif(greatest({sent} - {have}, 0), 0)"}
        where += " and grn_date >= date '1998-01-01' and not starts_with(coalesce(inv || 'R', ''), '26')"
    elif feed == "bb_alert_grn":
        col |= {"grn_date": "grn_date", "reject_reason": "if(id % 2 = 0, null, 'torn')"}
    elif feed == "bb_net_grn":
        col["grn_date"] = "if(id % 5 = 0, null, grn_date)"
    elif feed in ("flipkart_cb_grn", "flipkart_ppr_grn", "fatema_grn", "slveggies_grn"):
        col["grn_date"] = "grn_date"
        if feed == "flipkart_ppr_grn":
            col["inv"] = "inv"
        elif feed == "fatema_grn":
            col["feed_item_code"] = "coalesce(if(id % 2 = 0, feed_item_code, null), 'I' || cast(id as varchar))"
        elif feed == "slveggies_grn":
            col["received_qty"] = "coalesce(if(id % 2 = 0, received_qty, null), ordered_qty)"
    elif feed == "zepto_grn":
        booked = "if(id % 4 = 0, null, received_qty)"
        col |= {"feed_item_code": "lower(feed_item_code)", "received_qty": f"if(id % 5 in (0, 2) or coalesce({booked} > 0, false), {booked}, null)",
                "reject_reason": f"case when id % 5 in (1, 3) then if(coalesce({booked} > 0, false), 'grn booked, portal status ' || if(id % 5 = 1, 'PENDING_GRN', 'ASN_CREATED'), 'grn pending (' || if(id % 5 = 1, 'PENDING_GRN', 'ASN_CREATED') || ')') when id % 5 = 2 then 'cancelled' end"}
    elif feed == "amazon_grn":
        got = "if(id % 4 = 0, 0, received_qty)"
        short = "if(id % 5 = 0, 'shortage: yes', null)"
        col |= {"inv": "nullif(inv, '')", "received_qty": f"if(id % 3 = 0 or coalesce({got} > 0, false), {got}, null)", "reject_reason": f"case when id % 3 = 1 then if(coalesce({got} > 0, false), 'grn booked, portal status Open', 'not yet received (Open)') else {short} end"}
    elif feed == "flipkart_quick_grn":
        col |= {"received_qty": "coalesce(received_qty, 0)", "rejected_qty": "if(id % 3 = 0, nullif(rejected_qty, 0), null)", "reject_reason": "case when id % 3 = 1 then 'po cancelled' when coalesce(rejected_qty, 0) > 0 then 'rejected' end"}
        where += " and id % 3 < 2"
    numbers = ("received_qty", "ordered_qty", "rejected_qty")
    shown = [f"round(cast({v} as double), 4) as {k}" if k in numbers else f"cast({v} as date) as grn_date" if k == "grn_date" else f"cast({v} as varchar) as {k}" for k, v in col.items()]
    return f"select '{feed}' as feed, id, {', '.join(shown)}, source_file from receipt where {where}"


FEEDS_SQL = " union all ".join(_feed_sql(f) for f in _RAW)

_RANGE = "posting_date >= date '1996-03-10' and posting_date < date '1996-07-05'"
_LINKS = {
    "chained": f"""select distinct g, cast(floor(g / 16) as bigint) as c, g % 16 as p, lpad(cast(g * 7919 % 1000003 as varchar), 7, '0') as page from (select cast(floor(k / {CHAINED}) as bigint) as g from invoice_header)""",
    "linked": """select page, c, p = 0 and c % 5 <> 4 as first, lpad(cast(n * 7919 % 1000003 as varchar), 7, '0') as next_link
        from (select *, case when p = 15 and c % 11 = 10 then c * 16 + 3 when p = 15 and c % 7 = 6 then c * 16 when p = 15 or p = 14 and c % 11 = 10 then null else g + 1 end as n from chained)""",
    "follows": "select min(a.page) as before, b.page from linked a join linked b on a.next_link = b.page group by b.page",
    "walk": """select * from (with recursive w as (
            select page, page as chain, 0 as place, first from linked where page not in (select page from follows)
            union all select f.page, w.chain, w.place + 1, w.first from w join follows f on f.before = w.page) select * from w)""",
    "ranked": """select page, chain, place, if(first, 'linked', 'orphan') as status from walk
        union all select page, min(page) over (partition by c), null, 'cycle' from linked where page not in (select page from walk)""",
}
QUERIES = {"src_pages": paged, "src_dangling_links": dangling, "src_xml": xml, "src_registry": chosen, "src_keyed": keyed, "src_side": side, "src_states": states, "o2c_feeds": feeds, "src_pushdown": pushdown, "ing_zone_pull": zone_pull, "src_chain_order": chain_order, "src_chain_forks": chain_forks, "mrg_later_page": later_page, "src_xml_resume": xml_resume, "src_families": families}
_ASK = {
    "src_pages": f"select no, customer_no, posting_date, {money('amount')} from invoice_header where k % 3 = 0 or amount > 200000",
    "src_dangling_links": f"select cast(b + 1 as varchar) as next_link from (select distinct cast(floor(k / {PAGE}) as bigint) as b from invoice_header) where b + 1 not in (select cast(floor(k / {PAGE}) as bigint) from invoice_header)",
    "src_xml": "select customer_no, code, registration_no from ship_address where registration_no <> ''",
    "src_registry": "select 'Feed_' || state_code as name, 'odata' as family, true as chosen from gst_state where cast(state_no as int) % 4 = 2",
    "src_keyed": "select no, name, posting_group from customer_card",
    "src_side": """select 'memos' as table_name, if(coalesce(trim(external_no), '') = '', 'missing or blank key', 'failed') as reason, no from memo_header where coalesce(trim(external_no), '') = '' or k % 7 = 0""",
    "src_states": "select state_code, state_no, if(state_no > '20', upper(state_name), state_name) as state_name, state_no || '-' || if(state_no > '20', upper(state_name), state_name) as label from gst_state",
    "src_pushdown": f"select no, customer_no, posting_date, {money('amount')} from invoice_header where {_RANGE} and customer_no not in ('C00001', 'C00004') and (k % 3 = 0 or amount > 200000)",
    "ing_zone_pull": f"""select part, count(*) as files, count(*) filter (met) as opened, cast(sum(if(met, n, 0)) as bigint) as n_rows from (
        select strftime(date_trunc('month', posting_date), '%Y-%m-%d') as part, count(*) as n, max(posting_date) >= date '1996-03-10' and min(posting_date) < date '1996-07-05' and max(no) >= '27HYD' as met
        from invoice_header group by date_trunc('month', posting_date), floor(k / {PAGE})) group by part""",
    "src_xml_resume": f"select c_custkey // {ADDRESSES} as page, count(*) as n_rows, '36;' || lpad(max(c_custkey)::varchar, 9, '0') as last_key, count(*) >= {ADDRESSES} as more from customer group by 1",
    "src_families": "select 'odata' as family, customer_no || chr(10) || no as key from invoice_header union all select 'v2.0', 'id-' || k from invoice_header",
    "src_chain_order": "select page, chain, place, status from ranked",
    "src_chain_forks": "select b.page, a.page as before, a.page = min(a.page) over (partition by b.page) as kept from linked a join linked b on a.next_link = b.page qualify count(*) over (partition by b.page) > 1",
    "mrg_later_page": f"""select customer_no, arg_max(no, (chain, place, no)) as no, max(chain) as chain, arg_max(place, (chain, place, no)) as place
        from invoice_header join chained on g = cast(floor(k / {CHAINED}) as bigint) join ranked using (page) where status = 'linked' group by customer_no""",
    "o2c_feeds": FEEDS_SQL,
}
ORACLE_SQL = {name: with_tables(sql, _LINKS) for name, sql in _ASK.items()}
