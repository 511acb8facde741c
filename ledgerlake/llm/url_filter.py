"""Allow and block rules on URLs: a blocked Bloom filter passes possible hits to an exact hash join.

Everything is DataFrame expressions. The filter is a table of blocks of eight 64-bit words; a key sets one bit in each word of
one block, so a probe touches one row. It holds the listed URLs and their hosts: hosts are probed first, and only those that the exact join confirms
are probed with the lengths of their own rules' paths. Rules and filter are broadcast up to `limit` bytes and shuffled above it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join

WORDS = 8
BROADCAST_BYTES = 64 << 20


def split_url(url):
    """(host, path) of a URL column: host follows the first `://` up to `/`, `?`, `#` or the end with A-Z lower-cased, path goes on up to `?`, `#`
    or the end. Null and URLs without `://` give two empty strings."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _small(rows: int, row_bytes: int, df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if rows * row_bytes <= limit else df


def _key(blocks: int) -> dict:
    """Block number and the hash that holds the bit of each word, of a canonical key (host, path)."""
    return {"_block": F.pmod(F.xxhash64("host", "path"), F.lit(blocks)), "_bits": F.xxhash64("path", "host", F.lit(1))}


def _mask(word: int) -> str:
    return f"shiftleft(1L, cast(shiftright(_bits, {6 * word}) & 63 as int))"


def bloom_blocks(rules: DataFrame, blocks: int) -> DataFrame:
    """The blocked Bloom filter as a table: _block and words w0..w7."""
    return rules.withColumns(_key(blocks)).groupBy("_block").agg(*[F.expr(f"bit_or({_mask(i)})").alias(f"w{i}") for i in range(WORDS)])


def might_hit(candidates: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """Candidates (columns host, path and more) whose eight bits are all set; false positives remain."""
    test = " and ".join(f"(w{i} & {_mask(i)}) <> 0" for i in range(WORDS))
    return candidates.withColumns(_key(blocks)).join(filter_, "_block").where(test).select(*candidates.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow", limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    rules has host, path, verdict (`allow` or `block`). A rule fits its host and all subdomains when the URL's path starts with the rule's path;
    the longest host + path wins, then the longer host, then `block`. Null ids and repeated rows stay; a null or unparsable URL has empty host and
    path, no rule and the default verdict; an empty rule table gives every row the default. Other columns of pages are ignored.
    """
    rules = rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''")
    stats = rules.agg(F.count("*"), F.collect_set(F.size(F.split("host", r"\."))), F.max(F.length("host") + F.length("path"))).first()
    n_rules, labels, widest = stats  # a host name has few labels
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    if not n_rules:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n_rules * 32 / (64 * WORDS)))))
    keys = rules.select("host", "path").union(rules.select("host", F.lit("")))  # listed URLs, and their hosts alone
    filter_ = _small(min(blocks, 2 * n_rules), 8 * (WORDS + 1), bloom_blocks(keys, blocks), limit)
    by_host = _small(n_rules, 2 * widest + 64, rules.groupBy("host").agg(F.collect_set(F.length("path")).alias("lengths")), limit)
    rules = _small(n_rules, 2 * widest + 64, rules.select("host", "path", "verdict"), limit)
    parts = F.split("u_host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(x) for x in sorted(labels)]), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    distinct = urls.where("host <> ''").select(F.col("host").alias("u_host"), F.col("path").alias("u_path")).distinct()
    # Hosts first: only a host that has a rule is probed with its own rules' path lengths.
    hosts = distinct.select("u_host").distinct().select("u_host", F.explode(suffixes).alias("host"), F.lit("").alias("path"))
    listed = might_hit(hosts, filter_, blocks).join(by_host, "host").select("u_host", "host", "lengths")
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("u_path")), lambda n: F.substring("u_path", F.lit(1), n))
    candidates = spread_join(distinct, listed, "u_host", "u_path").where("host is not null").select("u_host", "u_path", "host", F.explode(prefixes).alias("path"))
    hits = might_hit(candidates, filter_, blocks).join(rules, ["host", "path"])
    best = (
        hits.groupBy("u_host", "u_path")
        .agg(F.max(F.struct((F.length("host") + F.length("path")).alias("n"), F.length("host").alias("h"), "verdict", F.concat("host", "path").alias("rule"))).alias("best"))
        .select(F.concat("u_host", "u_path").alias("whole"), "best.rule", "best.verdict")
    )
    keyed = urls.withColumn("whole", F.when(F.col("host") != "", F.concat("host", "path")))  # a path is empty or starts with a slash: no two are alike
    return spread_join(keyed, best, "whole", id_col).select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
