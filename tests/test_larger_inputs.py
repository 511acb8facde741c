"""Codes, landed pages and derived tables on inputs that are larger than the test tables."""

import duckdb
from pyspark.sql import functions as F

from ledgerlake import fixtures, queries
from ledgerlake.plans import ledger_store, register, stages
from ledgerlake.plans.o2c import match_receipts
from ledgerlake.queries import o2c as o2c_queries
from ledgerlake.sources import pages, pushdown

SF = "/root/testdata/sf0.001"


def test_no_two_keys_share_a_code(spark, tmp_path):
    """Customers from 100,000 and parts from 1,000,000 on keep all their digits."""
    spark.createDataFrame([(k, f"n{k}", 0, 1.0, "AUTO") for k in (7, 12345, 123456, 123457)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, "a", "b", "c", 1, 1.0) for k in (7, 123456, 1234567, 1234568)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    t = fixtures.Tables(spark, str(tmp_path))
    assert {r["no"] for r in t.customer_card.collect()} == {"C00007", "C12345", "C123456", "C123457"}
    assert {r["no"] for r in t.item_card.collect()} == {"FG/000007", "FG/123456", "FG/1234567", "FG/1234568"}
    assert t.ship_address.select("customer_no").distinct().count() == 4


def test_feeds_meet_the_item_map_as_it_is(spark, monkeypatch):
    """The map isn't repeated for each platform, which Spark broadcasts by the size of the map alone."""
    f, seen = o2c_queries.Flow(spark, "/root/testdata/sf0.001"), {}
    monkeypatch.setattr(f, "_once", lambda name, build: build())
    monkeypatch.setattr(o2c_queries.p, "receipt_lines", lambda rows, item_map, renames: seen.setdefault("map", item_map))
    monkeypatch.setattr(o2c_queries.p, "match_receipts", lambda *a: a[0])
    f.__dict__ |= {"hdr": None, "lines": None}
    _ = f.feed_matched
    assert seen["map"].count() == f.t.item_map.count()


def test_many_pages_stand_in_few_files(spark, tmp_path):
    rows = spark.range(2000).select("id", F.lit("x").alias("v"))
    pages.land_pages(rows, F.floor(F.col("id") / 2), f"{tmp_path}/pages", (F.floor(F.col("id") / 2) + 1).cast("string"))
    assert 0 < len(list((tmp_path / "pages").rglob("*.json"))) <= 8
    got = pages.read_pages(spark, f"{tmp_path}/pages", None, "struct<id:bigint,v:string>")
    assert sorted((r["_page"], r["id"]) for r in got.collect()) == sorted((str(k // 2), k) for k in range(2000))
    assert [r["next_link"] for r in pages.dangling_links(spark, f"{tmp_path}/pages").collect()] == ["1000"]


def test_a_narrow_read_writes_no_tables(spark):
    """A query that reads a few columns of derived lines once leaves nothing staged."""
    stages.discard_kept(spark)
    for name in ("ing_fit_count", "aud_missing_objects", "reg_doc_fallback", "reg_doc_union"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert not [k for k in stages._kept if k[0] == spark.sparkContext.applicationId]


def test_pages_of_a_month_share_files(spark, tmp_path):
    """The number of files follows the bundles, not the pages, and a page is read from its place in its file."""
    rows = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("é"), F.lpad(F.col("id").cast("string"), 5, "0"))).alias("no"))
    folder = f"{tmp_path}/zoned"
    pushdown.land_zoned(rows, F.col("k") % 2, F.floor(F.col("k") / 20), folder, ["k"], F.floor(F.col("k") / 2000))
    assert len(list((tmp_path / "zoned").rglob("bundle=*/*.txt"))) == 4
    assert spark.read.parquet(f"{folder}/_zones").count() == 400
    source = pushdown.read_zoned(spark, folder, "k bigint, no string")
    for got, want in ((source, rows), (source.where("k >= 1990 and k < 2031"), rows.where("k >= 1990 and k < 2031")), (source.where("k in (5, 399, 3998)"), rows.where("k in (5, 399, 3998)"))):
        assert sorted((r["k"], r["no"] or "") for r in got.collect()) == sorted((r["k"], r["no"] or "") for r in want.collect())


def test_a_narrow_register_leaves_out_what_it_does_not_read(spark):
    """Its columns are those of the whole register, and steps that they don't read are neither joined nor written."""
    t = fixtures.Tables(spark, SF, written=False)
    for columns in (["document_no", "line_no", "mrp", "gmv"], ["document_no", "line_no", "gst_hsn_sac", "gst_jurisdiction_type"], ["document_no", "line_no", "gstn", "company_gstin"], ["document_no", "line_no", "igst", "cogs"]):
        assert register.register(t, columns).select(columns).exceptAll(register.register(t).select(columns)).count() == 0
    assert register.steps_of(None) == {"g", "gd", "c", "lr", "cr"} and register.steps_of(["mrp"]) == {"c"}
    stages.discard_kept(spark)
    assert queries.QUERIES["reg_mrp_gmv"](spark, SF).count() > 0
    assert {k[1] for k in stages._kept if k[0] == spark.sparkContext.applicationId} == {"line_base", "invoice_line"}


def test_the_least_line_number_is_one_of_texts(spark, tmp_path):
    """A part on the lines 20000 and 100000 of one order: the query, like its SQL, takes the least text."""
    con = duckdb.connect()
    for name in ("customer", "part", "orders", "lineitem"):
        con.execute(f"create table {name} as select * from '{SF}/{name}.parquet'")
    k = con.execute("select max(o_orderkey) from orders where o_orderdate >= date '1998-06-01'").fetchone()[0]
    con.execute(f"delete from lineitem where l_orderkey = {k}")
    con.execute(f"insert into lineitem select {k}, case when n = 10 then 2 else n end, 1, n, 1.0, 1.0, 0.0, 0.0, 'N', 'O', timestamp '1998-07-01' from range(1, 12) r(n)")
    for name in ("customer", "part", "orders", "lineitem"):
        con.execute(f"copy {name} to '{tmp_path}/{name}.parquet' (format parquet)")
    ours = [r["line_no"] for r in queries.QUERIES["o2c_lines"](spark, str(tmp_path)).collect()]
    theirs = [r[0] for r in con.execute(f"select line_no from ({queries.ORACLE_SQL['o2c_lines']})").fetchall()]
    assert "100000" in ours and sorted(ours) == sorted(theirs)


def test_each_match_join_is_made_once(spark):
    """All seven methods and their conditions on single candidates, from one join per key."""
    h = [("27AHD-00001", "A", "P1", "AHD", "00001", False), ("27BLR-00002", "A", "P2", "BLR", "00002", False), ("27BLR-00003", "A", "P2", "BLR", "00003", False), ("27AHD-00004", "A", "P4", "AHD", "00004", False), ("28AHD-00004", "A", "P5", "AHD", "00004", True)]
    headers = spark.createDataFrame([(n, c, po, n.replace("-", ""), b, five, gone) for n, c, po, b, five, gone in h], "invoice_no string, customer_no string, po_number_u string, inv_norm string, branch string, num5 string, cancelled boolean").withColumn("invoice_date", F.lit("2001-02-01").cast("date"))
    lines = spark.createDataFrame([("27BLR-00002", "i", 5), ("27BLR-00003", "j", 6)], "invoice_no string, item_no string, invoiced_qty int")
    g = [  # order number, candidates of the reference, item and quantity; what is found
        ("", "27AHD00001", None, None, None, 0, "27AHD-00001", "invoice_exact"), ("P1", "", "AHD", "00001", None, 0, "27AHD-00001", "invoice_core+po"), ("", "", "BLR", "00003", None, 0, "27BLR-00003", "invoice_core"),
        ("P9", "", "BLR", "00003", None, 0, "27BLR-00003", "invoice_core"), ("P4", "", "BLR", "00003", None, 0, "27AHD-00004", "po_unique"), ("", "", "AHD", "00004", None, 0, None, None), ("P1", "", None, None, None, 0, "27AHD-00001", "po_unique"),
        ("P2", "", None, None, "i", 5, "27BLR-00002", "po+item+qty"), ("P2", "", None, None, "j", 1, "27BLR-00003", "po+item+date"), ("P2", "", None, None, "x", 1, "27BLR-00002", "po_ambiguous"), ("P5", "", None, None, None, 0, None, None),
    ]
    schema = "feed string, row_id long, part int, po_number string, cand_norm string, cand_branch string, cand_num5 string, item_no string, received_qty int"
    for own, lists in ((F.array(F.lit("A"), F.lit("B")).alias("customer_nos"), None), (F.lit("L").alias("customer_list"), spark.createDataFrame([("L", "A"), ("L", "B")], "customer_list string, customer_no string"))):
        receipts = spark.createDataFrame([("f", n, 0, *x[:6]) for n, x in enumerate(g)], schema).select("*", own, F.lit(None).cast("date").alias("grn_date"))
        out = match_receipts(receipts, headers, lines, lists)
        assert [(r["invoice_no"], r["match_method"]) for r in out.orderBy("row_id").collect()] == [x[6:] for x in g]
        assert out._jdf.queryExecution().analyzed().toString().count("Join ") <= (5 if lists is None else 9)


def test_replacement_keys_are_cleaned_in_one_pass(spark):
    """The keys of a live invoice come from one read of the headers, and candidates that are written already give the same rows."""
    f = o2c_queries.Flow(spark, SF)
    fresh = o2c_queries.p.replacements(f.hdr, f.lines, f.memos, f.t.channel_site)
    assert fresh.exceptAll(f.replaced).count() == 0 and {r[0] for r in f.replaced.select("status").distinct().collect()} == {"REINVOICED", "NOT_REINVOICED"}
    assert "Union" not in fresh._jdf.queryExecution().analyzed().toString()


def test_buckets_follow_the_ledger(spark, monkeypatch):
    """A larger ledger has more buckets, not larger ones, and the same rows."""
    assert [ledger_store.buckets_of(n) for n in (0, 600_000, 36_000_000)] == [16, 16, 72]
    before = queries.QUERIES["reg_bucketed"](spark, SF)
    monkeypatch.setattr(ledger_store, "ROWS", 200)
    after = queries.QUERIES["reg_bucketed"](spark, SF)
    assert after.exceptAll(before).count() == 0 and after.count() == before.count()
    assert len(after.inputFiles()) > 1.5 * len(before.inputFiles())


def test_feeds_join_their_customers_once_a_list(spark):
    """The text of a platform's customers is made below the join with the feeds' rows, not again for each of them."""
    plan = queries.QUERIES["o2c_feeds"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("array_join" in x for x in plan)
    assert not any("array_join" in x for x in plan[: next(n for n, x in enumerate(plan) if "Join LeftOuter" in x)])
