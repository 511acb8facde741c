"""Merge, strategies and normalisation on hand-built rows, with the edge rows that the fixtures lack."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import normalize as n
from ledgerlake.operators import lineage as lin
from ledgerlake.operators import merge as m
from ledgerlake.operators import strategies as s
from ledgerlake.plans import ingest_run as run
from ledgerlake.plans import o2c
from ledgerlake.plans.buckets import BucketTable
from ledgerlake.plans.stages import discard_kept, shared_folder, stage_once
from ledgerlake.sources import pages
from ledgerlake.streaming.ingest import read_landing, upsert_available, upsert_with_state

NOW = datetime(2024, 1, 2)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_merge_inserts_updates_keeps(spark):
    old = spark.createDataFrame([("1", "a", 5, "own", datetime(2000, 1, 1)), ("2", None, 6, "own", datetime(2000, 1, 1)), ("3", "c", 7, None, datetime(2000, 1, 1))], "k string, v string, n int, mine string, _synced_at timestamp")
    new = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", None, "x"), (4, "d", 8, None)], "k int, v string, n int, extra string")
    out = {r["k"]: r for r in m.merge(old, new, ["k"], F.lit(NOW)).collect()}
    assert [out[k]["_action"] for k in "1234"] == ["update", "update", "keep", "insert"]  # extra is new and not null on 1
    assert out["2"]["v"] == "b" and out["2"]["n"] is None and out["2"]["mine"] == "own"
    assert out["3"]["_synced_at"] == datetime(2000, 1, 1) and out["4"]["_synced_at"] == NOW


def test_merge_preserves_and_skips_unchanged(spark):
    old = spark.createDataFrame([("1", 2.0, "a")], "k string, budget double, v string")
    same = m.merge(old, spark.createDataFrame([("1", 9.0, "a")], "k string, budget double, v string"), ["k"], F.lit(NOW), preserve=("budget",)).first()
    assert same["_action"] == "keep" and same["budget"] == 2.0


def test_keys(spark):
    df = spark.createDataFrame([("1", "a"), (None, "a"), (" ", "a"), ("2", "")], "k string, part string")
    good, bad = m.split_invalid(df, ["k", "part"], ("part",))
    assert good.count() == 2 and bad.count() == 2
    twice = spark.createDataFrame([("1", 1), ("1", 2)], "k string, page int")
    assert m.rekey_check(twice, ["k"]) == 1
    with pytest.raises(ValueError, match="same key"):
        m.resolve_duplicates(twice, ["k"])
    assert m.resolve_duplicates(twice, ["k"], "last", ["page"]).first()["page"] == 2


def test_windows():
    assert s.windows(date(2024, 1, 15), date(2024, 3, 2)) == [(date(2024, 1, 15), date(2024, 2, 1)), (date(2024, 2, 1), date(2024, 3, 1)), (date(2024, 3, 1), date(2024, 3, 2))]
    assert s.windows(date(2024, 1, 2), date(2024, 1, 2)) == []
    assert len(s.windows(date(2024, 1, 1), date(2024, 1, 9), "weekly")) == 2
    with pytest.raises(ValueError):
        s.windows(date(2024, 1, 1), date(2024, 1, 2), "hourly")


def test_state_moves_only_on_success():
    state = {"last_sync_at": None}
    failed = s.next_state(state, "failed", NOW, resume="link")
    assert failed["last_sync_at"] is None and failed["resume_url"] == "link" and s.plan_phase(False, failed) == "backfill"
    done = s.next_state(failed, "success", NOW, resume="link")
    assert done["last_sync_at"] == NOW and done["resume_url"] is None and s.plan_phase(False, done) == "incremental" and s.plan_phase(True, done) == "backfill"


def test_names_and_flatten(spark):
    names = {"No.": "No", "": "field", "1st": "f_1st", "order": "order_field", "a--b": "a_b", "a__b": "a__b", "Rank": "Rank_field", "User": "User", "_x_": "x"}
    assert {x: n.column_name(x) for x in names} == names
    df = spark.createDataFrame([(x,) for x in names] + [("x" * 99,)], "raw string")
    assert dict(rows(df.select("raw", n.safe_name(F.col("raw")).alias("safe")), "raw", "safe")) == names | {"x" * 99: "x" * 63}
    assert len(n.column_name("x" * 99)) == 63 and n.table_name("Sales__Invoice Excel") == "t_sales_invoice"
    df = spark.createDataFrame([(("x", 1), [])], "a struct<b:string,`@odata.id`:int>, c array<int>")
    assert n.flatten(df).columns == ["a_b", "c"] and n.flatten(df).first()["c"] == "[]"


def test_infer_and_widen(spark):
    df = spark.createDataFrame([("00123", "2024-01-01", "true", None, 1, 2.5, [1]), ("2", "2024-02-30", "1", None, None, None, None)], "a string, b string, c string, d string, e int, f double, g array<int>")
    assert dict(rows(n.infer_types(df), "column_name", "type_name")) == {"a": "string", "b": "date", "c": "string", "d": "string", "e": "bigint", "f": "decimal(18,4)", "g": "json"}
    got = df.select(n.temporal(F.col("b")).alias("t")).select("t.*")
    assert [tuple(r) for r in got.collect()] == [(date(2024, 1, 1), None, None), (None, None, "2024-02-30")]
    assert n.infer_types(df.limit(0)).where("type_name = 'string'").count() == 7
    wide = n.widen(spark.createDataFrame([], "k string, x bigint").schema, spark.createDataFrame([], "k int, x decimal(18,4), y date").schema, ("k",))
    assert [f.dataType.simpleString() for f in wide] == ["string", "decimal(38,10)", "date"]


def test_series_and_gaps(spark):
    stored = spark.createDataFrame([("26A-00002",), ("26B-00009",), ("",), (None,)], "no string")
    high = s.series_high(stored, "no")
    assert rows(high, "series", "high") == [("26A", "26A-00002"), ("26B", "26B-00009")]
    source = spark.createDataFrame([("26A-00002",), ("26A-00003",), ("26AX-00001",), ("26C-00001",)], "no string")
    scope = s.series_scope(high, s.series_seen(source, "no"), dated=False)
    assert rows(s.series_pull(source, scope, "no"), "no") == [("26A-00003",), ("26AX-00001",), ("26C-00001",)]
    with pytest.raises(ValueError):
        s.series_seen(source, "no", "day", date(2024, 1, 1))


def test_dependents_with_a_cycle_and_parallel_paths(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("x", "y")], "parent string, child string")
    assert rows(lin.dependents(edges, "a"), "node", "depth") == [("b", 1), ("c", 1), ("d", 2), ("e", 3)]
    with pytest.raises(ValueError, match="e"):
        lin.refuse_if_blocked(lin.dependents(edges, "a"), spark.createDataFrame([("e", "materialised")], "node string, kind string"))


def test_receipt_feeds_take_one_shape(spark):
    channel = spark.createDataFrame([("C1", "Zepto"), ("C2", "Zepto")], "customer_no string, platform string")
    zepto = spark.createDataFrame([(1, "PO1", "SKU", "PENDING_GRN", None, 4, "f"), (2, "PO1", "SKU", "CANCELLED", 3, 4, "f")], "id int, po_no string, sku string, status string, grn_quantity int, qty int, source_file string")
    milk = spark.createDataFrame([(1, "P", "V1", "G1", date(2024, 1, 1), "A", 1, 2, "f")], "id int, po_number string, vendor_invoice_number string, grn_number string, grn_date date, article string, accepted_qty int, received_qty int, source_file string")
    reliance = spark.createDataFrame([(7, "P", "V1", "G9", date(2024, 1, 1), "Metro hall", "{}", "f"), (8, "P", "V2", "G2", date(2024, 1, 1), "METRO hall", '{"article":"A","accepted_qty":"1","challan_qty":"3"}', "f")], "id int, po_number string, vendor_invoice_number string, grn_number string, grn_date date, shipping_address string, raw_data string, source_file string")
    out = o2c.receipt_feeds({"zepto_grn": zepto, "milkbasket_grn": milk, "reliance_grn": reliance}, channel)
    got = {(r["feed"], r["id"]): r for r in out.collect()}
    assert len(got) == 4 and ("reliance_grn", 7) not in got  # its invoice is in the other feed
    assert got["zepto_grn", 1]["received_qty"] is None and got["zepto_grn", 1]["reject_reason"] == "grn pending (PENDING_GRN)" and got["zepto_grn", 1]["customer_nos"] == ["C1", "C2"]
    assert got["reliance_grn", 8]["platform"] == "Metro" and got["reliance_grn", 8]["rejected_qty"] == 2


def test_dependents_are_whole_or_refused(spark):
    chain = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(53)], "parent string, child string")
    got = lin.dependents(chain, "n0")
    assert got.count() == 53 and got.agg(F.max("depth")).first()[0] == 53
    with pytest.raises(ValueError, match="below depth 2"):
        lin.dependents(chain, "n0", 2)
    with pytest.raises(ValueError, match="cycle"):
        lin.dependents(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b")], "parent string, child string"), "a")


SERVICE = run.Service("Feed", "t_feed", ("k",), ("day",), history_field="day", start=date(2024, 1, 1))


def _lake(spark, name):
    import uuid

    return run.Lake(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")


def test_runs_resume_and_keep_their_watermark(spark):
    lake, now = _lake(spark, "runs"), datetime(2024, 3, 31, 12)
    rows_ = spark.createDataFrame([("a", date(2024, 1, 5), "1"), ("b", date(2024, 2, 5), "2"), ("c", date(2024, 3, 5), "3"), ("old", date(2023, 1, 1), "4")], "k string, day date, v string")
    assert run.run(lake, SERVICE, rows_, now, max_windows=1) == "success"
    assert lake.state("Feed")["last_sync_at"] is None and lake.state("Feed")["history_through"] == date(2024, 2, 1) and rows(lake.read("t_feed"), "k") == [("a",)]
    broken = rows_.withColumn("v", F.raise_error(F.lit("no answer")).cast("string"))
    assert run.run(lake, SERVICE, broken, now) == "failed"
    assert "no answer" in lake.state("Feed")["last_error"] and lake.state("Feed")["history_through"] == date(2024, 2, 1) and rows(lake.read("t_feed"), "k") == [("a",)]
    assert run.run(lake, SERVICE, rows_, now) == "success"
    assert lake.state("Feed")["last_sync_at"] == now and rows(lake.read("t_feed"), "k") == [("a",), ("b",), ("c",)]
    later = spark.createDataFrame([("c", date(2024, 3, 30), "9", 1), (None, date(2024, 4, 1), "9", 1)], "k string, day date, v string, extra int")
    assert run.run(lake, SERVICE, later, datetime(2024, 4, 2)) == "partial_failure" and lake.state("Feed")["last_sync_at"] == now
    assert rows(lake.read("t_feed").where("k = 'c'"), "k", "v", "extra") == [("c", "9", 1)]
    assert lake.side("summary", run.SUMMARY).count() == 4 and lake.side("quarantine", run.SIDE).count() == 1


def test_tables_before_the_first_run_and_their_keys(spark):
    lake = _lake(spark, "first")
    run.create_table(lake, SERVICE, spark.createDataFrame([("007", "2024-01-01", 5)], "k string, day string, n int"))
    assert lake.read("t_feed").count() == 0 and dict(lake.read("t_feed").dtypes) == {"k": "string", "day": "date", "n": "int", "_synced_at": "timestamp"}
    assert run.guard_key(lake, SERVICE)
    with pytest.warns(UserWarning, match="the key of t_feed is k"):
        assert not run.guard_key(lake, run.Service("Feed", "t_feed", ("k", "n"), ("day",)))


def test_stream_goes_on_after_a_restart(spark):
    import uuid

    folder = f"{shared_folder(spark)}/restart-{uuid.uuid4().hex}"
    table = BucketTable(spark, f"{folder}/table", ["k"])
    land = lambda data, kind: spark.createDataFrame(data, kind).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    pull = lambda checkpoint, schema: upsert_available(read_landing(spark, f"{folder}/landing", spark.createDataFrame([], schema).schema), table, f"{folder}/{checkpoint}", ["at"])
    land([("a", 1), ("b", 1)], "k string, at int")
    assert pull("one", "k string, at int") == 0 and "_synced_at" in table.read(0).columns
    assert pull("one", "k string, at int") == 0  # nothing new: the newest version stays the newest
    land([("a", 2)], "k string, at int")
    assert pull("one", "k string, at int") == 1
    land([("c", 3, "x")], "k string, at int, extra string")
    assert pull("two", "k string, at int, extra string") == 2  # a new checkpoint reads all again and goes on after the versions that stand
    assert rows(table.read(2), "k", "at") == [("a", 2), ("b", 1), ("c", 3)] and "extra" in table.read(2).columns


def test_registry_choice_and_families(spark):
    services = spark.createDataFrame([("a", True), ("b", None), ("c", False)], "name string, enabled boolean")
    assert rows(pages.choose(services, ["a", "b"]), "name") == [("a",), ("b",)]
    with pytest.raises(ValueError, match="c, d"):
        pages.choose(services, ["a", "c", "d"])
    with pytest.raises(ValueError, match="no service"):
        pages.registry(services.where("name = 'c'"))
    assert pages.service_key("odata", ["No"]) == ["No"] and pages.service_key("v2.0", ["No"]) == ["id"]


def test_kept_stages_are_built_once_and_discarded(spark):
    built = []
    build = lambda: built.append(1) or spark.range(3)
    assert stage_once(spark, "numbers", build, "here").count() == 3 and stage_once(spark, "numbers", build, "here").count() == 3 and len(built) == 1
    discard_kept(spark)
    assert stage_once(spark, "numbers", build, "here").count() == 3 and len(built) == 2


def test_receipts_of_several_customers_meet_each_one(spark):
    kind = "feed string, row_id int, part int, customer_nos array<string>, po_number string, cand_norm string, cand_branch string, cand_num5 string, grn_date date, item_no string, received_qty int"
    receipts = spark.createDataFrame([("f", 1, 0, ["C1", "C2", "C2"], "P", "", "AHD", "00001", None, None, 1), ("f", 2, 0, ["C3"], "P", "", "AHD", "00001", None, None, 1)], kind)
    headers = spark.createDataFrame([("I1", "C2", "P", "I1", "AHD", "00001", date(2024, 1, 1), False), ("I9", "C9", "P", "I9", "AHD", "00001", date(2024, 1, 2), False)], "invoice_no string, customer_no string, po_number_u string, inv_norm string, branch string, num5 string, invoice_date date, cancelled boolean")
    lines = spark.createDataFrame([], "invoice_no string, item_no string, invoiced_qty int")
    assert rows(o2c.match_receipts(receipts, headers, lines), "row_id", "invoice_no", "match_method") == [(1, "I1", "invoice_core+po"), (2, None, None)]
    # the same by lists that are named once; a list without members, an unknown one and none at all match by the order number alone
    listed = receipts.withColumn("customer_list", F.element_at("customer_nos", 1)).drop("customer_nos")
    more = spark.createDataFrame([("f", 3, 0, "P", "I1", None, None, None, None, 1, None), ("f", 4, 0, "", "I1", None, None, None, None, 1, "none"), ("f", 5, 0, "", "I1", None, None, None, None, 1, "C1")], listed.schema)
    lists = spark.createDataFrame([("C1", "C1"), ("C1", "C2"), ("C1", "C2"), ("C3", "C3")], "customer_list string, customer_no string")
    found = o2c.match_receipts(listed.unionByName(more), headers, lines, lists)
    assert rows(found, "row_id", "invoice_no", "match_method") == [(1, "I1", "invoice_core+po"), (2, None, None), (3, "I1", "invoice_exact"), (4, None, None), (5, "I1", "invoice_exact")]


def test_customer_lists_name_each_feed_s_customers_once(spark):
    channel = spark.createDataFrame([("C7", "Zepto"), ("C8", "Zepto"), ("C8", "Zepto"), (None, "Zepto"), ("C9", None)], "customer_no string, platform string")
    lists = rows(o2c.customer_lists(channel), "customer_list", "customer_no")
    assert len(lists) == len(set(lists)) and [x for x in lists if x[0] == "Zepto"] == [("Zepto", "C7"), ("Zepto", "C8")]
    assert {no for name, no in lists if name.startswith("C00152,")} == {"C00152", "C00153", "C00154", "C00156", "C00157"} and (o2c.METRO, o2c.METRO) in lists
    zepto = spark.createDataFrame([(1, "P", "s", 1, 2, "COMPLETED", "f")], "id int, po_no string, sku string, grn_quantity int, qty int, status string, source_file string")
    assert o2c.feed_rows({"zepto_grn": zepto}).first().customer_list == "Zepto"
    empty = spark.createDataFrame([], channel.schema)
    assert o2c.receipt_feeds({"zepto_grn": zepto}, empty).first().customer_nos == []


def test_landed_pages_are_read_whole(spark):
    import uuid

    folder = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    rows_ = spark.range(50).withColumn("v", F.col("id") * 2)
    pages.land_pages(rows_.coalesce(1), F.floor(F.col("id") / 7), folder, (F.floor(F.col("id") / 7) + 1).cast("string"))
    got = pages.read_pages(spark, folder, "v < 80 or false", "struct<id:bigint,v:bigint>")
    assert rows(got, "id") == [(k,) for k in range(40)] and rows(pages.dangling_links(spark, folder), "next_link") == [("8",)]


def test_streams_keep_their_state(spark):
    lake = _lake(spark, "stream")
    spark.createDataFrame([("a", 1), ("b", 1)], "k string, at int").write.parquet(f"{lake.root}/landing")
    kind = spark.createDataFrame([], "k string, at int").schema
    pull = lambda key: upsert_with_state(lake, "feed", read_landing(spark, f"{lake.root}/landing", kind), BucketTable(spark, f"{lake.root}/table-{key}", [key]), f"{lake.root}/checkpoint-{key}", ["at"], NOW)
    assert pull("k") == "success" and lake.state("feed")["records_processed"] == 2 and lake.state("feed")["last_sync_at"] == NOW
    assert pull("nothing") == "failed" and lake.state("feed")["last_error"] and lake.state("feed")["last_sync_at"] == NOW
