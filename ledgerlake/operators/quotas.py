"""Quotas over an object inventory: usage by owner patterns, decisions, unclaimed objects, budgets, alerts.

inventory: object_name, bytes (a file or partition listing, the large side). policy: owner, patterns (array), budget_gb, stop_pct, warn_pct - a row
for each owner, a few dozen, which is why it is the broadcast side; its size is checked by Spark's own threshold where no hint is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GB = 1 << 30
RANK = {"ok": 0, "warn": 1, "stop": 2}


def _claims() -> Column:
    return F.exists("patterns", lambda p: F.rlike(F.col("object_name"), p))


def _grouped(inventory: DataFrame) -> DataFrame:
    """One row per object name: partitions of one object are summed before the patterns are tried."""
    return inventory.groupBy("object_name").agg(F.sum("bytes").alias("bytes"))


def usage(inventory: DataFrame, policy: DataFrame) -> DataFrame:
    """owner, used_bytes, n_objects: an object counts for every owner with a pattern that fits; owners without objects have 0."""
    found = _grouped(inventory).join(policy.select("owner", "patterns"), _claims()).groupBy("owner").agg(F.sum("bytes").alias("used_bytes"), F.count("*").alias("n_objects"))
    return policy.select("owner").join(found, "owner", "left").select("owner", F.coalesce("used_bytes", F.lit(0)).alias("used_bytes"), F.coalesce("n_objects", F.lit(0)).alias("n_objects"))


def decide(used: DataFrame, policy: DataFrame, total_bytes: Column, volume: tuple[float, float, float]) -> DataFrame:
    """owner, level, reason. volume is (size in GB, stop %, warn %); its stop goes first, then the owner's stop and warn, then its warn."""
    size, stop, warn = volume
    whole = F.round(total_bytes.cast("double") / GB * 100 / size, 1)
    j = used.join(policy.where(F.coalesce("enabled", F.lit(True))), "owner", "left").withColumns({"whole_pct": whole, "pct": F.round(F.try_divide(F.col("used_bytes").cast("double") / GB * 100, F.col("budget_gb").cast("double")), 1)})
    said = lambda what, x: F.concat(F.lit(what), x.cast("string"), F.lit("%"))
    ladder = [(F.col("whole_pct") >= stop, "stop", said("volume at ", F.col("whole_pct"))), (F.col("pct") >= F.col("stop_pct"), "stop", said("owner at ", F.col("pct"))), (F.col("pct") >= F.col("warn_pct"), "warn", said("owner at ", F.col("pct"))), (F.col("whole_pct") >= warn, "warn", said("volume at ", F.col("whole_pct")))]
    level, reason = F.lit("ok"), F.lit("within budget")
    for test, name, text in reversed(ladder):
        level, reason = F.when(test, name).otherwise(level), F.when(test, text).otherwise(reason)
    return j.select("owner", "pct", level.alias("level"), reason.alias("reason"))


def unclaimed(inventory: DataFrame, policy: DataFrame, least_bytes: int) -> DataFrame:
    """Objects of least_bytes or more that no pattern claims, the largest first."""
    objects = _grouped(inventory).where(F.col("bytes") >= least_bytes)
    return objects.join(policy.select("patterns"), _claims(), "left_anti").orderBy(F.desc("bytes"), "object_name")


def auto_budget(used: DataFrame, policy: DataFrame, free_gb: float, least_gb: float = 0.5) -> DataFrame:
    """owner, grant_gb: in owner order each over 1.25 times its use gets what it lacks, from what is left, while more than least_gb is left.

    Grants are clipped running totals of the wants: one ordered window over the owners, a row each."""
    want = F.greatest(F.ceil(F.col("used_bytes").cast("double") / GB * 1.25) - F.col("budget_gb").cast("double"), F.lit(0.0))
    before = Window.orderBy("owner").rowsBetween(Window.unboundedPreceding, -1)  # owners are few: the policy's rows
    j = used.join(policy, "owner").withColumn("want", want).withColumn("spent", F.coalesce(F.sum("want").over(before), F.lit(0.0)))
    left = F.greatest(F.lit(free_gb) - F.col("spent"), F.lit(0.0))
    return j.withColumn("grant_gb", F.when(left > least_gb, F.least("want", left)).otherwise(F.lit(0.0))).where("grant_gb > 0").select("owner", "budget_gb", "grant_gb")


def alerts(levels: DataFrame, state: DataFrame, now: Column, cooldown_hours: int) -> DataFrame:
    """owner, level, send, and the state to keep: a worse level is sent at once, the same one after the cooldown, ok never."""
    rank = lambda x: F.when(x == "stop", RANK["stop"]).when(x == "warn", RANK["warn"]).otherwise(RANK["ok"])
    j = levels.join(state.select("owner", F.col("level").alias("_was"), "last_sent_at"), "owner", "left")
    rested = F.col("last_sent_at").isNull() | (now >= F.col("last_sent_at") + F.make_interval(hours=F.lit(cooldown_hours)))
    send = (F.col("level") != "ok") & ((rank(F.col("level")) > rank(F.coalesce("_was", F.lit("ok")))) | rested)
    return j.withColumn("send", send).select("owner", "level", "reason", "send", F.when(F.col("send"), now).otherwise(F.col("last_sent_at")).alias("last_sent_at"))


def alert_message(sent: DataFrame) -> DataFrame:
    """One message of the alerts to send, in owner order: a line for each owner."""
    return sent.where("send").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "level", "owner", "reason"))), "\n").alias("message"))


def pressure(used: DataFrame, column: str, limit_gb: float, threshold_pct: float) -> DataFrame:
    """pct, over: used bytes as a share of a limit, and whether it reaches the threshold; both limits come from the caller's settings."""
    pct = F.round(F.col(column).cast("double") / GB * 100 / limit_gb, 1)
    return used.select(pct.alias("pct"), (pct >= threshold_pct).alias("over"))
