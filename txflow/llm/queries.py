"""The registered queries of the training-data operators: each applies its operator to its whole table.

The operators have real outputs (texts, spans, ids); the digests that the queries return are derived here.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm import bpe, collocations, conversations, language, lattice, licenses, packing, pii, ppm, secret_scan, simhash, topk, url_rules
from txflow.llm.common import count_kind, listed, table
from txflow.llm.sql import SQL  # noqa: F401  (part of this module's interface)

# fixed values: verdict, host and path of the url rules
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark, URL_RULES))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [count_kind(F.col("base"), i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base"), pii.KINDS), 256).alias("base_sha256"),
                        listed(F.col("spans"), pii.KINDS).alias("spans"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), path)
    return bpe.decode_ids(encoded, path, digest=True).select(
        "doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    word = F.transform("places", lambda p: p["word"])
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(word).alias("first_word"), F.array_max(word).alias("last_word"),
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language.predict(docs.select("doc_id", "text"), language.train(docs))
    return told.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"),
                       F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    counts = [count_kind(F.col("base"), i).alias(f"n_{kind}") for i, kind in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base"), secret_scan.KINDS), 256).alias("base_sha256"),
                        listed(F.col("spans"), secret_scan.KINDS).alias("spans"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"), damage=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filters, op2_packing, op3_simhash, op4_topk, op5_lattice, op6_pii, op7_bpe,
                            op8_licenses, op9_language, op10_secrets, op11_collocations, op12_lm_scoring, op13_conversations)}
