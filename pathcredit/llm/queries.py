"""Registered queries of the corpus operators: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.llm import conversations, decontaminate, exact_dedup, licenses, merkle, mixing, oracles, pitman_yor, quality, \
    sharding, simhash, suffixes, url_filter, warc

N_SHARDS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.records_of_pages(_table(spark, sf_dir, "pages"))
    return warc.resolve_revisits(records)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages")).withColumn("ratio", F.round("ratio", 6) + F.lit(0.0))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("removed").cast("long")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(conversations.damaged(_table(spark, sf_dir, "conversations")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(merkle.manifest(_table(spark, sf_dir, "documents"), tamper=merkle.one_more_char))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_byte_shards, op2_quality, op3_warc_revisits, op4_licenses, op5_url_filter, op6_mixing, op7_simhash,
    op8_exact_dedup, op9_decontamination, op10_pitman_yor, op11_suffix_dedup, op12_conversation_repair,
    op13_merkle_manifest)}

LLM_ORACLES: dict[str, str] = {
    "op1_byte_shards": oracles.BYTE_SHARDS, "op3_warc_revisits": oracles.WARC_REVISITS,
    "op4_licenses": oracles.LICENSES, "op5_url_filter": oracles.URL_FILTER, "op6_mixing": oracles.MIXING, "op8_exact_dedup": oracles.EXACT_DEDUP,
    "op9_decontamination": oracles.DECONTAMINATION,
    "op11_suffix_dedup": oracles.PASSAGES, "op12_conversation_repair": oracles.CONVERSATIONS, "op13_merkle_manifest": oracles.MERKLE}
