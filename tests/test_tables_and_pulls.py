"""Sources that take filters, chains of pages, bucketed tables, resumable and keyed pulls."""

import random
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import lineage
from ledgerlake.operators import strategies as s
from ledgerlake.plans import ingest_run as run
from ledgerlake.plans import ledger_store
from ledgerlake.plans.buckets import BucketTable, bucket_of
from ledgerlake.plans.stages import children, create_file, remove, shared_folder, stage_once
from ledgerlake.sources import chain, pushdown
from ledgerlake.streaming.ingest import read_landing
from ledgerlake.streaming.stateful import series_high_stream

AT = datetime(2024, 5, 1)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def zoned(spark, n=120):
    folder = new_folder(spark, "zoned")
    df = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("A-"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("no"), F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("day"), (F.col("id") / 4).cast("decimal(18,4)").alias("amount"))
    df = df.withColumn("no", F.when(F.col("k") % 17 != 5, F.col("no")))
    pushdown.land_zoned(df, F.trunc("day", "MM"), F.floor(F.col("k") / 10), folder, ["no", "day"])
    return folder, df


def test_a_source_opens_only_the_pages_that_a_filter_can_meet(spark):
    folder, df = zoned(spark)
    source = pushdown.read_zoned(spark, folder, df.schema.simpleString()[7:-1].replace(":", " "))
    assert rows(source.na.fill("-"), "k", "no", "day", "amount") == rows(df.na.fill("-"), "k", "no", "day", "amount")
    near = (F.col("day") >= F.lit(date(2024, 2, 3))) & (F.col("day") < F.lit(date(2024, 2, 20))) & (F.col("k") % 2 == 0)
    want = rows(df.where(near), "k")
    zones = spark.read.parquet(f"{folder}/_zones")
    outside = [r["file"] for r in zones.where("least_day >= date'2024-02-20' or greatest_day < date'2024-02-03'").collect()]
    assert 0 < len(outside) < zones.count()
    for file in outside:  # a page that is opened now fails
        remove(spark, file)
        create_file(spark, file, "not a page")
    assert rows(source.where(near), "k") == want and source.where(near).rdd.getNumPartitions() == 1
    assert rows(source.where((F.col("no") >= "A-0033") & F.col("no").startswith("A-003") & near), "k") == [k for k in want if 33 <= k[0] < 40]
    assert pushdown.files_met(spark, folder, "greatest_day >= date'2024-02-03' and least_day < date'2024-02-20'").where("met").count() == zones.count() - len(outside)
    with pytest.raises(Exception, match="Expecting value"):
        source.count()


def test_parts_come_in_the_order_of_their_key(spark):
    folder, df = zoned(spark, 60)
    source = pushdown.read_zoned(spark, folder, "k bigint, no string, day date", "no").where("no is not null")
    for part in source.rdd.glom().collect():
        assert [r["no"] for r in part] == sorted(r["no"] for r in part) and len({r["day"].month for r in part}) == 1


def test_chains_of_pages_are_ranked(spark):
    rng = random.Random(2)
    for _ in range(3):
        names = [f"p{k:03d}" for k in rng.sample(range(1000), 60)]
        links = {a: rng.choice([b, b, b, b, None, "gone", rng.choice(names)]) for a, b in zip(names, [*names[1:], None], strict=True)}
        first = {n for n in names if rng.random() < 0.5}
        before = {}
        for a in sorted(links):
            if links[a] in links:
                before.setdefault(links[a], a)
        want = set()
        for page in links:
            seen, at = [page], page
            while at in before and before[at] not in seen:
                at = before[at]
                seen.append(at)
            cycle = at in before
            loop = [at := page] + [at := before[at] for _ in seen[1:]] if cycle else []
            want.add((page, min(loop), None, "cycle") if cycle else (page, at, len(seen) - 1, "linked" if at in first else "orphan"))
        pages = spark.createDataFrame([(a, b, a in first) for a, b in links.items()], "page string, next_link string, first boolean")
        assert {tuple(r) for r in chain.rank_pages(pages).collect()} == want
        named = {p: sorted(a for a in links if links[a] == p) for p in links}
        assert {tuple(r) for r in chain.forks(pages).collect()} == {(p, a, a == b[0]) for p, b in named.items() if len(b) > 1 for a in b}
    assert chain.rank_pages(pages.limit(0)).count() == 0


def test_a_merge_rewrites_only_the_buckets_it_touches(spark):
    table = BucketTable(spark, new_folder(spark, "table"), ["k"], 8)
    assert table.read() is None and table.versions() == []
    start = spark.range(200).select("id", F.col("id").cast("string").alias("k"), F.lit("a").alias("v"))
    before = table.merge(start, F.lit(AT))
    files = lambda m, b: children(spark, f"{table.path}/data/{m['buckets'][b]}/_bucket={b}")
    batch = start.where("id in (3, 4)").withColumns({"v": F.lit("b"), "extra": F.lit(7)})
    touched = {str(r[0]) for r in batch.select(bucket_of(["k"], 8)).distinct().collect()}
    old = {b: files(before, b) for b in before["buckets"]}
    after = table.merge(batch, F.lit(AT), tag="one")
    assert {b for b in after["buckets"] if after["buckets"][b] != before["buckets"][b]} == touched and len(touched) < 8
    assert all(files(after, b) == old[b] for b in old if b not in touched)
    assert rows(table.read().where("v = 'b'"), "id", "extra") == [(3, 7), (4, 7)] and table.read().count() == 200 and table.read(0).where("v = 'b'").count() == 0
    assert table.merge(batch, F.lit(AT), tag="one") == after and table.versions() == [0, 1]  # committed already
    stale = table.merge(batch.withColumn("v", F.lit("old")).withColumn("id", F.lit(0).cast("long")), F.lit(AT), newer=["id"])
    assert stale["version"] == 2 and table.read().where("v = 'b'").count() == 2  # a row that lies behind the stored one
    table.merge(start.where("id = 5").withColumn("id", F.lit("five")), F.lit(AT))
    assert dict(table.read().dtypes)["id"] == "string" and table.read().count() == 200 and rows(table.read().where("k = '5'"), "id") == [("five",)]
    assert table.retain(1) >= 1 and table.versions() == [3] and table.read().count() == 200
    none = table.read().select("id", "k", "v").limit(0)
    assert table.merge(none, F.lit(AT))["version"] == 3 and table.merge(none.withColumn("later", F.lit(1)), F.lit(AT))["version"] == 4
    assert table.read().count() == 200 and "later" in table.read().columns
    with pytest.raises(FileExistsError):  # two writers from one version: the second must merge again
        create_file(spark, f"{table.path}/_manifest/v4.json", "{}")


def test_a_failed_backfill_goes_on_behind_its_last_window(spark):
    lake, now = run.Lake(spark, new_folder(spark, "lake")), datetime(2024, 6, 10)
    service = run.Service("Feed", "t", ("k",), ("day",), history_field="day", start=date(2024, 1, 1))
    source = spark.createDataFrame([(f"k{m}", date(2024, m, 5), "old") for m in range(1, 7)], "k string, day date, v string")
    bad = source.withColumn("v", F.when(F.month("day") == 4, F.raise_error(F.lit("no answer")).cast("string")).otherwise(F.col("v")))
    assert run.run(lake, service, bad, now) == "failed"
    assert rows(lake.read("t"), "k") == [("k1",), ("k2",), ("k3",)]
    state = lake.state("Feed")
    assert state["history_through"] == date(2024, 4, 1) and state["records_processed"] == 3 and state["last_sync_at"] is None and "no answer" in state["last_error"]
    run.land_windows(lake, service, source, "day", [(date(2024, 4, 1), date(2024, 5, 1))])  # as a run that died between landing and merging
    assert run.run(lake, service, source.withColumn("v", F.lit("new")), now) == "success"
    assert rows(lake.read("t"), "k", "v") == [("k1", "old"), ("k2", "old"), ("k3", "old"), ("k4", "old"), ("k5", "new"), ("k6", "new")]
    assert lake.state("Feed")["last_sync_at"] == now and not children(spark, f"{lake.root}/_pull/Feed")
    assert run.run(lake, service, source.withColumn("v", F.lit("full")), now, full=True) == "success" and lake.read("t").where("v = 'full'").count() == 6


def test_open_rows_are_read_again_when_due_and_a_silent_source_is_told(spark):
    lake, kind = run.Lake(spark, new_folder(spark, "open")), "k string, day date, open boolean, v int"
    service = run.Service("Open", "t", ("k",), ("day",), history_field="day", start=date(2024, 1, 1), open_field="open", open_hours=24)
    first = spark.createDataFrame([("a", date(2024, 1, 5), True, 1), ("b", date(2024, 1, 5), True, 1), ("c", date(2024, 1, 5), False, 1)], kind)
    run.run(lake, service, first, datetime(2024, 2, 1))
    later = spark.createDataFrame([("a", date(2024, 1, 5), False, 2), ("b", date(2024, 1, 5), True, 2), ("c", date(2024, 1, 5), False, 2)], kind)
    run.run(lake, service, later, datetime(2024, 3, 1))
    assert rows(lake.read("t"), "k", "open", "v") == [("a", False, 2), ("b", True, 2), ("c", False, 1)] and lake.state("Open")["open_read_at"] == datetime(2024, 3, 1)
    run.run(lake, service, later.withColumn("v", F.lit(3)), datetime(2024, 3, 1, 5))
    assert rows(lake.read("t"), "v") == [(1,), (2,), (2,)]  # not due yet
    with pytest.warns(UserWarning, match="no open row, 1 are held open"):
        merged, missing = s.open_refresh(lake.read("t"), later.withColumn("open", F.lit(False)), "k")
    assert merged.count() == 0 and missing.count() == 0


def test_series_runs_sweep_gaps_but_not_at_first(spark):
    lake = run.Lake(spark, new_folder(spark, "series"))
    heads = run.Service("Heads", "h", ("no",), ("no",), strategy="full_refresh")
    lines = run.Service("Lines", "l", ("no", "line"), ("no",), strategy="series", series_field="no", parent="h", parent_field="no", parent_date="day", lookback_days=30)
    line = spark.createDataFrame([(f"A-{k}", 1) for k in range(1, 8)] + [("B-1", 1), ("C-1", 1)], "no string, line int")
    assert run.run(lake, lines, line, datetime(2024, 3, 1)) == "failed" and "isn't there yet" in lake.state("Lines")["last_error"]
    run.run(lake, heads, spark.createDataFrame([(f"A-{k}", date(2024, 1 if k < 3 else 2, 20)) for k in range(1, 8)] + [("B-1", date(2024, 2, 20))], "no string, day date"), datetime(2024, 3, 1))
    run.run(lake, lines, line.where("no not in ('A-2', 'A-4', 'A-7')"), datetime(2024, 3, 1))
    assert rows(lake.read("l"), "no") == [("A-1",), ("A-3",), ("A-5",), ("A-6",), ("B-1",)]  # C is no series of a parent
    run.run(lake, lines, line, datetime(2024, 3, 1, 6))
    assert rows(lake.read("l"), "no") == [("A-1",), ("A-3",), ("A-4",), ("A-5",), ("A-6",), ("A-7",), ("B-1",)]  # A-2's parent lies behind the lookback
    run.run(lake, lines, line, datetime(2024, 3, 1, 7), full=True)
    assert ("A-2",) in rows(lake.read("l"), "no")


def test_high_water_state_goes_on_after_restarts(spark):
    folder = new_folder(spark, "water")
    table, got = BucketTable(spark, f"{folder}/high", ["series"], 2), []
    for numbers in (["A-3", "B-1", None, "", "-9"], ["A-2", "B-7"], [], ["A-4", "C-1", "C-0"]):
        spark.createDataFrame([(x,) for x in numbers], "no string").coalesce(1).write.mode("append").parquet(f"{folder}/landing")
        out = series_high_stream(read_landing(spark, f"{folder}/landing", spark.createDataFrame([], "no string").schema), table, f"{folder}/checkpoint", "no")
        got.append(rows(out, "series", "high"))
    assert got == [[("A", "A-3"), ("B", "B-1")], [("A", "A-3"), ("B", "B-7")], [("A", "A-3"), ("B", "B-7")], [("A", "A-4"), ("B", "B-7"), ("C", "C-1")]]


def test_kept_stages_follow_their_inputs(spark):
    folder, built = new_folder(spark, "inputs"), []
    spark.range(3).write.parquet(folder)

    def made():
        built.append(1)
        return spark.read.parquet(folder)

    ask = lambda: stage_once(spark, "follow", made, folder, inputs=(folder,)).count()
    assert ask() == 3 and ask() == 3 and len(built) == 1
    spark.range(6).write.mode("append").parquet(folder)
    assert ask() == 9 and len(built) == 2


def test_cycles_are_named(spark):
    rng = random.Random(6)
    for n_nodes, n_edges in ((12, 16), (30, 40), (8, 40), (10, 6)):
        edges = {(rng.randrange(n_nodes), rng.randrange(n_nodes)) for _ in range(n_edges)}
        reach = set(edges)
        while (new := reach | {(a, d) for a, b in reach for c, d in edges if b == c}) != reach:
            reach = new
        want = {(str(a), min(str(b) for b in range(n_nodes) if (a, b) in reach and (b, a) in reach)) for a in range(n_nodes) if (a, a) in reach}
        got = lineage.cycles(spark.createDataFrame([(str(a), str(b)) for a, b in edges], "parent string, child string"))
        assert set(rows(got, "node", "cycle")) == want and got.count() == len(want)
    assert lineage.cycles(spark.createDataFrame([("a", "b"), (None, "a")], "parent string, child string")).count() == 0


def test_bucketed_ledgers_join_without_an_exchange(spark):
    lines = ledger_store.store_bucketed(spark.range(500).selectExpr("cast(id % 90 as string) as document_no", "cast(id div 90 as int) as line_no", "id as line_amount"), "lines")
    taxes = ledger_store.store_bucketed(lines.where("line_amount % 3 = 0").selectExpr("document_no", "line_no", "1 as amount"), "taxes")
    costs = ledger_store.store_bucketed(lines.selectExpr("document_no", "line_no", "line_amount as cost"), "costs")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = ledger_store.line_totals(lines, taxes, costs)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 500 and out.where("cost = line_amount and (tax = 1) <=> (line_amount % 3 = 0 or null) and tax_entries = int(line_amount % 3 = 0)").count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
