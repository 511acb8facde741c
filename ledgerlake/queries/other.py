"""Customer reference, quotas, lineage and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Tables, fixture, with_tables
from ..operators import customer_ref as r
from ..operators import lineage as lin
from ..operators import quotas as q
from .common import settled

TODAY = "2024-05-01"
POLICY = [("orders", ["^orders_", "^open_"], 0.0004, 90.0, 60.0, True), ("lines_a", ["_A$"], 0.001, 90.0, 30.0, True), ("lines_n", ["^line_.*_N$", "^odd_"], 0.0001, 80.0, 50.0, True), ("spare", ["^none$"], 0.1, 80.0, 50.0, None)]
VOLUME = (0.05, 95.0, 20.0)
_PATTERN_ROWS = ", ".join(f"('{o}', [{', '.join(repr(p) for p in ps)}], {b}, {s}, {w})" for o, ps, b, s, w, _ in POLICY)


def _step(build, written=True):
    return lambda spark, sf_dir: settled(build(Tables(spark, sf_dir, written)))


def _inventory(t):
    line = fixture(*t._at, "lineitem")
    return line.groupBy(F.concat_ws("_", F.lit("line"), F.date_format("l_shipdate", "yyyyMM"), "l_returnflag").alias("object_name")).agg((F.count("*") * 100000).alias("bytes")).unionByName(
        t.order_base.groupBy(F.concat(F.when(F.col("st") == "O", "open_").otherwise("orders_"), F.year("d").cast("string")).alias("object_name")).agg((F.count("*") * 1000).alias("bytes")))


def _policy(t):
    return t._at[0].createDataFrame(POLICY, "owner string, patterns array<string>, budget_gb double, stop_pct double, warn_pct double, enabled boolean")


def _levels(t):
    inventory = _inventory(t)
    total = inventory.agg(F.sum("bytes").alias("total"))
    return q.decide(q.usage(inventory, _policy(t)).crossJoin(F.broadcast(total)), _policy(t), F.col("total"), VOLUME)  # total is one row


def _alert_state(t):
    return t._at[0].createDataFrame([("orders", "stop", "2024-04-30 20:00:00"), ("lines_a", "warn", "2024-04-01 00:00:00")], "owner string, level string, sent string").select("owner", "level", F.to_timestamp("sent").alias("last_sent_at"))


def _edges(t):
    """A tree of objects over the customers, a third of them a level, with parallel edges, and one tree that nothing reaches."""
    c = fixture(*t._at, "customer")
    name = lambda x: F.concat(F.lit("v"), x.cast("string"))
    key = F.col("c_custkey")
    one = c.where("c_custkey > 0").select(name(F.floor((key - 1) / 3)).alias("parent"), name(key).alias("child"))
    return one.unionByName(c.where("c_custkey > 3 and c_custkey % 2 = 0").select(name(F.floor((key - 1) / 3) - 1).alias("parent"), name(key).alias("child")))


def _tags(t):
    rules = [(F.col("channel") == "OLD", {"match_rule": "by_hand", "platform": "Legacy"}), (F.col("platform") == "Zepto", {"match_rule": "by_item"})]
    return r.apply_tags(t.customer_ref.select("customer_no", "platform", "channel", "match_rule", "reviewed"), rules)


def _rings(t):
    """A tree over the customers, with rings of six of them in each hundred, two-way links and links to oneself."""
    k = fixture(*t._at, "customer").select(F.col("c_custkey").alias("k"))
    at = F.col("k") % 100
    up = k.where("k > 1").select("k", F.floor(F.col("k") / 2).alias("to"))
    ring = k.where(at <= 5).select("k", F.when(at == 5, F.col("k") - 5).otherwise(F.col("k") + 1).alias("to"))
    both = k.where(at == 50).select("k", (F.col("k") + 1).alias("to")).union(k.where(at == 51).select("k", (F.col("k") - 1).alias("to")))
    alone = k.where(F.col("k") % 97 == 0).select("k", F.col("k").alias("to"))
    links = up.union(ring).union(both).union(alone)
    return links.select(F.concat(F.lit("v"), F.col("k").cast("string")).alias("parent"), F.concat(F.lit("v"), F.col("to").cast("string")).alias("child"))


QUERIES = {
    "ref_channel_sync": _step(lambda t: r.sync_channel(t.customer_ref, t.customer_card).select("customer_no", "channel", F.col("_changed").alias("changed"))),
    "ref_platform_follow": _step(lambda t: r.follow_platform(t.customer_ref, t.channel_map, F.lit(TODAY).cast("date")).select("customer_no", "platform", "grn_feed", "match_rule", "note", "updated_at", F.col("_changed").alias("changed"))),
    "ref_changes": _step(lambda t: r.change_counts({"channel": r.sync_channel(t.customer_ref, t.customer_card), "platform": r.follow_platform(t.customer_ref, t.channel_map, F.lit(TODAY).cast("date")), "tags": _tags(t)})),
    "ref_po_stats": _step(lambda t: r.po_statistics(t.invoice_header)),
    "ref_missing_customers": _step(lambda t: r.missing_customers(t.customer_ref, t.customer_card, r.po_statistics(t.invoice_header))),
    "ref_tags": _step(lambda t: _tags(t).withColumnRenamed("_changed", "changed")),
    "quota_usage": _step(lambda t: q.usage(_inventory(t), _policy(t))),
    "quota_check": _step(_levels),
    "quota_pressure": _step(lambda t: q.pressure(_inventory(t).agg(F.sum("bytes").alias("used")), "used", VOLUME[0], 95.0)),
    "quota_unclaimed": _step(lambda t: q.unclaimed(_inventory(t), _policy(t), 5_000_000)),
    "quota_autobudget": _step(lambda t: q.auto_budget(q.usage(_inventory(t), _policy(t)), _policy(t), 3.7)),
    "quota_alert": _step(lambda t: q.alerts(_levels(t), _alert_state(t), F.lit("2024-05-01 00:00:00").cast("timestamp"), 24).select("owner", "level", "send", "last_sent_at")),
    "quota_message": _step(lambda t: q.alert_message(q.alerts(_levels(t), _alert_state(t), F.lit("2024-05-01 00:00:00").cast("timestamp"), 24))),
    "lin_blocking": _step(lambda t: lin.blocking(lin.dependents(_edges(t), "v0"), _edges(t).select(F.col("child").alias("node")).withColumn("kind", F.when(F.col("node").endswith("7"), "materialised").otherwise("view")))),
    "lin_cycles": _step(lambda t: lin.cycles(_rings(t))),
    "lin_dependents": _step(lambda t: lin.dependents(_edges(t), "v0")),
    "aud_missing_objects": _step(lambda t: lin.missing_objects(t.invoice_header.select(F.col("no").alias("object_name")), t.invoice_line.select(F.col("document_no").alias("object_name")).distinct()), written=False),
    "aud_missing_columns": _step(lambda t: lin.missing_columns(t.invoice_line.select(F.col("document_no").alias("object_name"), F.col("line_no").alias("column_name")), t.tax_entry.select(F.col("document_no").alias("object_name"), F.col("line_no").cast("string").alias("column_name")).distinct())),
}

STEPS = {
    "po_n": "select customer_no, coalesce(external_no, '') as po, count(*) as n from invoice_header group by 1, 2",
    "po_stat": "select customer_no, count(*) as pos, cast(sum(n) as bigint) as invoices, round(sum(n)::double / count(*)::double, 2) as inv_per_po, max(n) as max_invoices_per_po, round((count(*) filter (n > 1))::double / count(*)::double * 100, 1) as pct_multi from po_n group by 1",
    "inv_obj": "select 'line_' || strftime(l_shipdate, '%Y%m') || '_' || l_returnflag as object_name, count(*) * 100000 as bytes from lineitem group by 1 union all select if(st = 'O', 'open_', 'orders_') || cast(year(d) as varchar), count(*) * 1000 from order_base group by 1",
    "pol": f"select * from (values {_PATTERN_ROWS}) p(owner, patterns, budget_gb, stop_pct, warn_pct)",
    "used": "select p.owner, cast(coalesce(sum(i.bytes), 0) as bigint) as used_bytes, count(i.bytes) as n_objects from pol p left join inv_obj i on list_bool_or([regexp_matches(i.object_name, x) for x in p.patterns]) group by 1",
    "lvl0": f"select p.owner, round(u.used_bytes::double / 1073741824 * 100 / p.budget_gb, 1) as pct, round((select sum(bytes) from inv_obj)::double / 1073741824 * 100 / {VOLUME[0]}, 1) as whole, p.stop_pct, p.warn_pct from pol p join used u using (owner)",
    "lvl": f"""select owner, pct, case when whole >= {VOLUME[1]} or pct >= stop_pct then 'stop' when pct >= warn_pct or whole >= {VOLUME[2]} then 'warn' else 'ok' end as level,
        case when whole >= {VOLUME[1]} then 'volume at ' || whole::varchar || '%' when pct >= warn_pct then 'owner at ' || pct::varchar || '%' when whole >= {VOLUME[2]} then 'volume at ' || whole::varchar || '%' else 'within budget' end as reason from lvl0""",
    "was": "select * from (values ('orders', 'stop', timestamp '2024-04-30 20:00:00'), ('lines_a', 'warn', timestamp '2024-04-01 00:00:00')) w(owner, level, sent_at)",
    "alert": """select l.owner, l.level, l.reason, l.level <> 'ok' and (list_position(['ok', 'warn', 'stop'], l.level) > list_position(['ok', 'warn', 'stop'], coalesce(w.level, 'ok')) or w.sent_at is null or w.sent_at + interval 24 hours <= timestamp '2024-05-01') as send, w.sent_at from lvl l left join was w using (owner)""",
    "edge": """select 'v' || cast(cast(floor((c_custkey - 1) / 3) as bigint) as varchar) as parent, 'v' || c_custkey as child from customer where c_custkey >= 1
        union all select 'v' || cast(cast(floor((c_custkey - 1) / 3) - 1 as bigint) as varchar), 'v' || c_custkey from customer where c_custkey >= 4 and c_custkey % 2 = 0""",
    "latest": "select platform, customer_no, grn_feed, match_rule, row_number() over (partition by platform order by updated_at desc, customer_no) as place from customer_ref where platform is not null",
}

_ASK = {
    "ref_channel_sync": "select r.customer_no, coalesce(c.posting_group, r.channel) as channel, coalesce(c.posting_group is distinct from r.channel and c.posting_group is not null, false) as changed from customer_ref r left join customer_card c on c.no = r.customer_no",
    "ref_platform_follow": f"""select r.customer_no, if(ch, m.platform, r.platform) as platform, if(ch, coalesce(t.grn_feed, r.grn_feed), r.grn_feed) as grn_feed, if(ch, coalesce(t.match_rule, r.match_rule), r.match_rule) as match_rule,
        if(ch, concat_ws('; ', r.note, 'platform ' || coalesce(r.platform, 'none') || ' -> ' || m.platform || ' on {TODAY}'), r.note) as note, if(ch, date '{TODAY}', r.updated_at) as updated_at, ch as changed
        from (select r.*, coalesce(not r.reviewed and m.platform is not null and m.platform is distinct from r.platform, false) as ch from customer_ref r left join channel_map m using (customer_no)) r left join channel_map m using (customer_no)
        left join latest t on t.platform = m.platform and t.place = (select min(z.place) from latest z where z.platform = m.platform and z.customer_no <> r.customer_no)""",
    "ref_po_stats": "select * from po_stat",
    "ref_changes": "",
    "ref_missing_customers": "select c.no as customer_no, coalesce(c.name, c.search_name) as customer_name, c.posting_group as channel, if(s.pct_multi >= 5, 'ONE_PO_MANY_INVOICES', 'ONE_PO_ONE_INVOICE') as po_pattern, s.pos, s.invoices, s.pct_multi, false as reviewed from customer_card c join po_stat s on s.customer_no = c.no where c.no not in (select customer_no from customer_ref)",
    "ref_tags": """select customer_no, if(not reviewed and channel = 'OLD', 'Legacy', platform) as platform, channel, case when reviewed then match_rule when channel = 'OLD' then 'by_hand' when platform = 'Zepto' then 'by_item' else match_rule end as match_rule, reviewed,
        case when reviewed then false when channel = 'OLD' then match_rule <> 'by_hand' or platform is distinct from 'Legacy' when platform = 'Zepto' then match_rule <> 'by_item' else false end as changed from customer_ref""",
    "quota_usage": "select * from used",
    "quota_check": "select * from lvl",
    "quota_pressure": f"select pct, pct >= 95.0 as over from (select round(sum(bytes)::double / 1073741824 * 100 / {VOLUME[0]}, 1) as pct from inv_obj)",
    "quota_unclaimed": "select object_name, cast(sum(bytes) as bigint) as bytes from inv_obj i where not exists (select 1 from pol p where list_bool_or([regexp_matches(i.object_name, x) for x in p.patterns])) group by 1 having sum(bytes) >= 5000000",
    "quota_autobudget": """select owner, budget_gb, grant_gb from (select owner, budget_gb, if(3.7 - least(spent, 3.7) > 0.5, least(want, 3.7 - least(spent, 3.7)), 0) as grant_gb from (
        select owner, budget_gb, want, coalesce(sum(want) over (order by owner rows between unbounded preceding and 1 preceding), 0) as spent from (
        select p.owner, p.budget_gb::double as budget_gb, greatest(ceil(u.used_bytes::double / 1073741824 * 1.25) - p.budget_gb::double, 0) as want from pol p join used u using (owner)))) where grant_gb > 0""",
    "quota_alert": "select owner, level, send, if(send, timestamp '2024-05-01', sent_at) as last_sent_at from alert",
    "quota_message": "select coalesce(string_agg(level || ' ' || owner || ' ' || reason, chr(10) order by level || ' ' || owner || ' ' || reason) filter (send), '') as message from alert",
    "lin_dependents": "select node, cast(max(depth) as integer) as depth from walk group by 1",
    "aud_missing_objects": "select no as object_name from invoice_header where no not in (select document_no from invoice_line)",
    "aud_missing_columns": "select document_no as object_name, line_no as column_name from invoice_line where document_no in (select document_no from tax_entry) except select document_no, cast(line_no as varchar) from tax_entry",
}
_ASK["ref_changes"] = " union all ".join(f"select '{k}' as step, count(*) as n_rows, count(*) filter (changed) as n_changed from ({_ASK[v]})" for k, v in (("channel", "ref_channel_sync"), ("platform", "ref_platform_follow"), ("tags", "ref_tags")))
ORACLE_SQL = {name: with_tables(sql, STEPS) for name, sql in _ASK.items() if name != "lin_dependents"}
ORACLE_SQL["lin_dependents"] = f"with recursive edge as ({STEPS['edge']}), walk as (select child as node, 1 as depth from edge where parent = 'v0' union select e.child, w.depth + 1 from walk w join edge e on e.parent = w.node) {_ASK['lin_dependents']}"
ORACLE_SQL["lin_cycles"] = """with recursive link as (
        select 'v' || c_custkey as a, 'v' || (c_custkey // 2) as b from customer where c_custkey > 1
        union select 'v' || c_custkey, 'v' || if(c_custkey % 100 = 5, c_custkey - 5, c_custkey + 1) from customer where c_custkey % 100 <= 5
        union select 'v' || c_custkey, 'v' || (c_custkey + 1) from customer where c_custkey % 100 = 50 union select 'v' || c_custkey, 'v' || (c_custkey - 1) from customer where c_custkey % 100 = 51
        union select 'v' || c_custkey, 'v' || c_custkey from customer where c_custkey % 97 = 0),
    reach as (select a, b from link union select r.a, l.b from reach r join link l on l.a = r.b)
    select x.a as node, min(x.b) as cycle from reach x join reach y on y.a = x.b and y.b = x.a group by x.a"""
ORACLE_SQL["lin_blocking"] = ORACLE_SQL["lin_dependents"].replace(_ASK["lin_dependents"], "select node, cast(max(depth) as integer) as depth from walk where node like '%7' group by 1")
