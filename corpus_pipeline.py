"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, PII, packing.

Each stage reads what its predecessor wrote; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontam, langid, minhash, packing, pii
from ledgerlake.llm.common import read_table, shared_dir

ORACLE_SQL = None  # tokenizers, Feistel networks and trained models are not expressible; tests/llm holds brute-force versions


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letter) go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id."""
    return minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets in the texts become surrogates."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    return packing.pack_sequences(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("replace_pii", replace_pii), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written to the shared folder and read again."""
    docs, folder = read_table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
