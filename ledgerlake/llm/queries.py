"""One query per operator, with production parameters, over its whole table; SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact, langid, media, merkle, oracles, order, packing, pii, simhash, suffix, trie, url_filter, warc
from .common import read_table

URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences in a keyed order, written as shards and read back."""
    return order.list_shards(order.write_shards(read_table(spark, sf_dir, "documents")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labelled ones that are not held out."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark items each document covers."""
    return decontam.find_contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to bundles and read back through their index."""
    planned = warc.plan_revisits(read_table(spark, sf_dir, "pages"))
    return warc.read_bundles(warc.write_bundles(planned)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of its personal data and secrets."""
    return pii.replace_pii(read_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the strings of 400 bytes that start anywhere else."""
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page by the rules above."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and group of every document."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_media_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as motion-JPEG, with what its stored bytes give back and its timed clips."""
    return media.media_features(media.store_text(read_table(spark, sf_dir, "documents")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_sequences(read_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return trie.prefix_nodes(trie.rebuilt(trie.turns(read_table(spark, sf_dir, "conversations"))))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    return exact.find_copies(read_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's leaf and proof, and what the manifest says where line ends went missing from the documents of an even checksum."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.audit(read_table(spark, sf_dir, "documents"), {"text": tampered})


QUERIES = {f.__name__: f for f in (op1_training_order, op2_language_id, op3_decontaminate, op4_warc, op5_pii_surrogates, op6_suffix_dedup, op7_url_filter, op8_simhash, op9_media_avi, op10_packing, op11_prefix_trie, op12_exact_dedup, op13_merkle_manifest)}

ORACLE_SQL = {
    "op11_prefix_trie": oracles.OP11,
    "op12_exact_dedup": oracles.OP12,
    "op13_merkle_manifest": oracles.OP13,
    "op4_warc": """
with body as (select page_id, coalesce(html, '') as html from pages),
     d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha1(html) as payload_digest from body),
     k as (select payload_digest, max(page_id) as keeper from d where payload_bytes >= 1000 group by payload_digest)
select d.page_id, d.payload_bytes, d.payload_digest,
       case when k.keeper is not null and k.keeper is distinct from d.page_id then 'revisit' else 'response' end as record_type,
       case when k.keeper is not null and k.keeper is distinct from d.page_id then k.keeper end as refers_to
from d left join k on d.payload_digest = k.payload_digest""",
    "op7_url_filter": """
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
     s as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
     r(h, p, v) as (values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
     f as (select page_id, host, path, h || p as rule, v, row_number() over (partition by page_id order by length(h || p) desc, length(h) desc) as n
           from s left join r on (host = h or host like '%.' || h) and starts_with(path, p))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from f where n = 1""",
}
