"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm import language, packing, secret_scan, simhash
from txflow.llm.common import saved, table

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, directly or by others, the one of smallest id stays."""
    return simhash.keep_one(docs, words=4, max_bits=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed sequence, with its token ids."""
    packed = packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("secret scans", secrets), ("packing", pack)]

# DuckDB has no way to train and apply the language model: the other stages are tested against brute force, the first by
# its held-out accuracy
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
