"""What steps leave on disk: tables that are written, and shuffle files."""

import time

from pyspark.sql import functions as F

from ledgerlake import fixtures, queries
from ledgerlake.plans import o2c, register, stages

SF = "/root/testdata/sf0.001"


def shuffle_files(spark) -> int:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(k).getName().startswith("shuffle_") for k in range(found.length()))


def kept(spark) -> set:
    return {k[1] for k in stages._kept if k[0] == spark.sparkContext.applicationId}


def test_a_step_leaves_no_shuffle_files(spark):
    """They go when the step is written, and the session's settings are as before."""
    held = [spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count() for _ in range(3)]
    settings = [spark.conf.get(k, None) for k in stages.LEAN]
    before = shuffle_files(spark)
    back = [stages.stage(df, "few") for df in held]
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and [spark.conf.get(k, None) for k in stages.LEAN] == settings
    assert {x.count() for x in back} == {7}


def test_the_register_writes_few_tables(spark):
    """Of the derived tables only those that several steps read are written; then the register itself, which ends its shuffles."""
    stages.discard_kept(spark)
    got = queries.QUERIES["reg_full"](spark, SF)
    assert kept(spark) == {"line_base", "invoice_line", "tax_entry", "register"}
    t = fixtures.Tables(spark, SF, written=False)
    assert got.count() == register.documents(t.invoice_header, t.invoice_line, t.memo_header, t.memo_line).count()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_the_match_keeps_narrow_tables(spark):
    """The whole receipts are written for the match alone; what stays is what later steps read, and a narrow query writes no whole bridge as adjusted."""
    stages.discard_kept(spark)
    assert queries.QUERIES["o2c_live"](spark, SF).count() > 0
    found = kept(spark)
    assert {"o2c-matched", "o2c-bridge", "o2c-moved", "o2c-live"} <= found and not found & {"o2c-receipts", "o2c-rows", "o2c-hits", "o2c-have", "o2c-adjusted"}
    left = {x.rsplit("-", 1)[0] for x in stages.children(spark, stages.shared_folder(spark)) if x.startswith("o2c-")}
    assert not left & {"o2c-rows", "o2c-hits", "o2c-have"}
    assert [df for at, (_, df) in stages._kept.items() if at[1] == "o2c-matched" and at[0] == spark.sparkContext.applicationId][0].columns == [*o2c.MATCHED, "invoice_no", "match_method"]


def test_receipts_without_a_code_keep_their_places(spark):
    """Items come before the places among equal rows; renamed, unmapped and blank codes, and references of several parts."""
    raw = spark.createDataFrame([("f", k, "P", "C", "po1 .", inv, "G", code, "Any", 1.0) for k, inv, code in ((1, "A, B", "S1"), (2, "A, B", "S1"), (3, None, None), (4, None, None), (5, "A", "S9"))], "feed string, id long, platform string, customer_list string, po string, inv string, grn_no string, feed_item_code string, map_platform string, received_qty double")
    raw = raw.withColumns({"grn_date": F.lit(None).cast("date"), "ordered_qty": F.lit(1), "rejected_qty": F.lit(0), "reject_reason": F.lit(None).cast("string"), "source_file": F.lit("x")})
    item_map = spark.createDataFrame([("Any", "s1", "FG/1"), ("Any", "s2", None)], "platform string, sku string, item_no string")
    renames = spark.createDataFrame([("FG/1", "TG/1")], "old_no string, new_no string")
    seen = []
    out = o2c.receipt_lines(raw, item_map, renames, lambda df: seen.append(df.columns) or df)
    got = sorted((r["row_id"], r["part"], r["invoice_ref"], r["po_number"], r["item_no"], r["dup_seq"]) for r in out.collect())
    assert got == [(1, 0, "A", "PO1", "TG/1", 1), (1, 1, "B", "PO1", "TG/1", 2), (2, 0, "A", "PO1", "TG/1", 3), (2, 1, "B", "PO1", "TG/1", 4), (3, 0, "", "PO1", None, 1), (4, 0, "", "PO1", None, 2), (5, 0, "A", "PO1", None, 1)]
    assert len(seen) == 1 and "item_no" in seen[0] and "cand_norm" not in seen[0]


def test_a_list_of_customers_is_written_once_a_file(spark, tmp_path):
    """Lists of more than a megabyte, which Parquet would write again in each row."""
    for name in ("region", "nation", "part", "supplier", "events"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.range(900_000).selectExpr("id as c_custkey", "concat('n', id) as c_name", "0 as c_nationkey", "1.0d as c_acctbal", "'AUTO' as c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey < 100").write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey < 100").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = queries.QUERIES["o2c_feeds"](spark, str(tmp_path))
    df.coalesce(1).write.parquet(f"{tmp_path}/out")
    chars, longest = spark.read.parquet(f"{tmp_path}/out").agg(F.sum(F.length("customer_nos")), F.max(F.length("customer_nos"))).first()
    written = sum(x.stat().st_size for x in (tmp_path / "out").glob("*.parquet"))
    assert longest > 1 << 20 and chars > 20 * longest and written < 4 * longest


def test_narrow_registers_end_their_shuffles(spark):
    """Where several grouped steps meet, what is returned reads a written table."""
    stages.discard_kept(spark)
    for name in ("reg_gstn", "reg_hsn"):
        assert "Exchange" not in queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert queries.QUERIES["reg_monthly_totals"](spark, SF)._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
