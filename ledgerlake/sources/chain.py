"""The order of landed pages along their links, by pointer doubling.

A page names the next one, so the order of a pull is a list that no column holds. Each page knows its predecessor; in each round it takes over what the page
it points at has found, so distances double and a chain of n pages is ranked in log2(n) equi-joins. A page that two others name keeps the predecessor of
the smaller name (the other link is a fork); pages whose pointers never end stand in a cycle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stages import discard, stage


def rank_pages(pages: DataFrame) -> DataFrame:
    """pages (page, next_link, first) -> page, chain (its first page), place (from 0), status.

    status: `linked` in a chain that begins with a page that a request named (first), `orphan` in another chain, `cycle` (chain is the cycle's smallest
    page, place null). A page that landed twice stands once, with the smaller of its links; links to pages that haven't landed end a chain."""
    once = stage(pages.groupBy("page").agg(F.min("next_link").alias("next_link"), F.max(F.coalesce("first", F.lit(False))).alias("first")), "pages")
    before = once.select(F.col("page").alias("before"), F.col("next_link").alias("page")).where("page is not null").groupBy("page").agg(F.min("before").alias("before"))
    at = stage(once.select("page").join(before, "page", "left").select("page", F.coalesce("before", "page").alias("to"), F.col("before").isNotNull().cast("long").alias("steps"), F.col("before").isNull().alias("done"), F.col("page").alias("low")), "chain")
    reach, total = 1, once.count()
    while reach < total and at.where("not done").limit(1).count():
        far = at.select(F.col("page").alias("to"), F.col("to").alias("far"), F.col("steps").alias("more"), F.col("done").alias("ended"), F.col("low").alias("lower"))
        ahead = at.where("not done").join(far, "to").select("page", F.col("far").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ended").alias("done"), F.least("low", "lower").alias("low"))
        new = stage(at.where("done").unionByName(ahead), "chain")
        discard(at)
        at, reach = new, reach * 2
    starts = once.select(F.col("page").alias("to"), "first")
    ranked = at.join(starts, "to", "left")
    status = F.when(~F.col("done"), "cycle").when(F.col("first"), "linked").otherwise("orphan")
    return ranked.select("page", F.when(F.col("done"), F.col("to")).otherwise(F.col("low")).alias("chain"), F.when(F.col("done"), F.col("steps")).alias("place"), status.alias("status"))


def forks(pages: DataFrame) -> DataFrame:
    """page, before, kept: the links to pages that several pages name; the one of the smallest name is kept."""
    links = pages.where("next_link is not null").select(F.col("next_link").alias("page"), F.col("page").alias("before")).distinct().join(pages.select("page").distinct(), "page", "left_semi")
    many = links.groupBy("page").agg(F.min("before").alias("first"), F.count("*").alias("n")).where("n > 1")
    return links.join(many, "page").select("page", "before", (F.col("before") == F.col("first")).alias("kept"))
