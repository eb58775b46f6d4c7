"""The corpus pipeline: documents to shards of clean, distinct, mixed text.

STAGES run in order; each takes (spark, docs, sf_dir), works on every row its
predecessor kept, and is written as Parquet and read again as the next one's
docs. The order that mixing gives the rows lies in its files, and sharding cuts
the rows in that order, so every shard holds the sources at their target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathcredit.llm import decontaminate, mixing, quality, sharding, simhash
from pathcredit.llm.common import input_order, materialize

N_SHARDS = 8
SHINGLE, MAX_BITS = 4, 4

#: A classifier, XXH64 and a seeded order of files have no SQL form.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, interleaved at the sources' target weights."""
    return mixing.in_mixed_order(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contiguous shards of near-equal bytes, in the order of the input's files."""
    stored = docs if input_order(docs) else materialize(docs)
    return sharding.shard_by_bytes(stored, N_SHARDS, order=input_order(stored))


STAGES = [("quality", classify), ("near_duplicates", deduplicate), ("decontamination", decontaminated), ("mixing", mix),
          ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
