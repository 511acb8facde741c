"""Upkeep of the customer reference: channel, platform, order-number pattern, missing customers, rule tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sync_channel(ref: DataFrame, cards: DataFrame) -> DataFrame:
    """ref with the channel of the customer card where that differs; `_changed` tells which rows."""
    card = cards.select(F.col("no").alias("customer_no"), F.col("posting_group").alias("_new"))
    j = ref.join(card, "customer_no", "left")
    changed = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("channel"))
    return j.withColumn("_changed", changed).withColumn("channel", F.when(changed, F.col("_new")).otherwise(F.col("channel"))).drop("_new")


def follow_platform(ref: DataFrame, channels: DataFrame, today: Column) -> DataFrame:
    """Rows not reviewed take the platform of the channel map, and feed and rule of that platform's latest other row, with a note."""
    target = channels.select("customer_no", F.col("platform").alias("_platform"))
    newest = Window.partitionBy("platform").orderBy(F.col("updated_at").desc(), "customer_no")
    top = ref.where("platform is not null").withColumn("_place", F.row_number().over(newest)).where("_place <= 2").select(F.col("platform").alias("_platform"), F.col("customer_no").alias("_no"), F.struct("_place", F.col("customer_no").alias("no"), "grn_feed", "match_rule").alias("_t"))
    templates = top.groupBy("_platform").agg(F.sort_array(F.collect_list("_t")).alias("_ts"))  # two rows a platform
    j = ref.join(target, "customer_no", "left").join(templates, "_platform", "left")
    moved = F.col("_platform").isNotNull() & ~F.coalesce("reviewed", F.lit(False)) & ~F.col("_platform").eqNullSafe(F.col("platform"))
    other = F.get(F.filter("_ts", lambda x: x["no"] != F.col("customer_no")), F.lit(0))
    note = F.concat_ws("; ", "note", F.concat(F.lit("platform "), F.coalesce("platform", F.lit("none")), F.lit(" -> "), "_platform", F.lit(" on "), today.cast("string")))
    new = {"platform": F.col("_platform"), "grn_feed": F.coalesce(other["grn_feed"], "grn_feed"), "match_rule": F.coalesce(other["match_rule"], "match_rule"), "note": note, "updated_at": today}
    return j.withColumn("_changed", moved).select(*[F.when(F.col("_changed"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in ref.columns], "_changed")


def po_statistics(headers: DataFrame) -> DataFrame:
    """Per customer: order numbers, invoices, invoices an order number (mean and most), share of order numbers with several. Blank numbers count as one."""
    per_po = headers.groupBy("customer_no", F.coalesce("external_no", F.lit("")).alias("po")).agg(F.count("*").alias("n"))
    stats = per_po.groupBy("customer_no").agg(F.count("*").alias("pos"), F.sum("n").alias("invoices"), F.max("n").alias("max_invoices_per_po"), F.count_if(F.col("n") > 1).alias("multi"))
    share = lambda a, b, places: F.round(F.col(a).cast("double") / F.col(b).cast("double") * (100 if places == 1 else 1), places)
    return stats.select("customer_no", "pos", "invoices", share("invoices", "pos", 2).alias("inv_per_po"), "max_invoices_per_po", share("multi", "pos", 1).alias("pct_multi"))


def missing_customers(ref: DataFrame, cards: DataFrame, stats: DataFrame, many_from: float = 5.0) -> DataFrame:
    """Reference rows for customers without one: several invoices an order number when at least many_from per cent of the numbers have them."""
    new = cards.join(ref.select(F.col("customer_no").alias("no")), "no", "left_anti").join(stats.withColumnRenamed("customer_no", "no"), "no")
    pattern = F.when(F.col("pct_multi") >= many_from, "ONE_PO_MANY_INVOICES").otherwise("ONE_PO_ONE_INVOICE")
    return new.select(F.col("no").alias("customer_no"), F.coalesce("name", "search_name").alias("customer_name"), F.col("posting_group").alias("channel"), pattern.alias("po_pattern"), "pos", "invoices", "pct_multi", F.lit(False).alias("reviewed"))


def apply_tags(ref: DataFrame, rules: list[tuple[Column, dict[str, str]]]) -> DataFrame:
    """The first rule that fits a row sets its columns; reviewed rows stay. `_changed` tells which rows differ after it."""
    free = ~F.coalesce("reviewed", F.lit(False))
    columns = dict.fromkeys(c for _, sets in rules for c in sets)
    first = reduce(lambda w, ir: w.when(ir[1][0], ir[0]), enumerate(rules[1:], 1), F.when(rules[0][0], 0))
    j = ref.withColumn("_rule", F.when(free, first))
    new = {c: reduce(lambda v, ir, c=c: F.when(F.col("_rule") == ir[0], ir[1][1][c]).otherwise(v) if c in ir[1][1] else v, enumerate(rules), F.col(c)) for c in columns}
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(v) for c, v in new.items()])
    return j.withColumn("_changed", changed).select(*[new.get(c, F.col(c)).alias(c) for c in ref.columns], "_changed")


def change_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """One row per step: rows and changed rows of its frame (column _changed)."""
    one = [df.agg(F.count("*").alias("n_rows"), F.count_if("_changed").alias("n_changed")).select(F.lit(name).alias("step"), "n_rows", "n_changed") for name, df in steps.items()]
    return reduce(DataFrame.unionByName, one)
