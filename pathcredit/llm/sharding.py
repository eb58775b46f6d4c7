"""Contiguous shards of near-equal byte size, by global prefix sums.

The text is scanned once, for its size and checksum; only (order key, size,
checksum) moves. Rows are range-partitioned by the order key, so Spark splits
any range into partitions of similar length; each partition's total goes into a
table with one row per partition, whose running sum gives every partition's
start. A row's global byte offset is its partition's start plus a running sum
inside the partition, and its shard is the equal-width target its middle byte
falls into. No step holds more than one partition's narrow rows in a task.

Defined results: a null text has no bytes (size 1, checksum 0); null ids sort
first; ties and repeated rows are told apart by a running row number, so each
repeated row gets its own slot; an empty table gives an empty result; a shard
may stay empty when one document is larger than the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathcredit.llm.common import materialize, whole_text


def _offsets(ranges: DataFrame) -> DataFrame:
    """One row per range partition: bytes and rows in front of it (bounded by the partition count)."""
    totals = ranges.groupBy("pid").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("pid", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                         F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                   order: list[Column] | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, slot, byte_offset) for every row of ``docs``.

    ``order`` gives the contiguous order (default: the id). ``slot`` counts the
    shard's rows from 0 in that order; ``byte_offset`` is the row's global start.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text = whole_text(text_col)
    order = order or [F.col(id_col)]
    names = [f"k{i}" for i in range(len(order))]
    narrow = materialize(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), *[o.alias(n) for o, n in zip(order, names)],
        F.monotonically_increasing_id().alias("tie")))
    spark = docs.sparkSession
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*names, "size", "crc", "tie"]
    # Written, so that totals and rows see the same sampled range bounds.
    ranges = materialize(narrow.repartitionByRange(n_ranges, *keys).withColumn("pid", F.spark_partition_id()))

    offsets = _offsets(ranges)
    local = W.partitionBy("pid").orderBy(*keys).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (ranges.withColumn("run", F.sum("size").over(local)).withColumn("rn", F.row_number().over(
        W.partitionBy("pid").orderBy(*keys)))
        .join(F.broadcast(offsets), "pid")  # one row per range partition
        .withColumn("byte_offset", F.col("bytes_before") + F.col("run") - F.col("size"))
        .withColumn("rank", F.col("rows_before") + F.col("rn") - 1))
    total = ranges.agg(F.sum("size")).first()[0] or 1
    # Twice the middle byte against twice the total, exact in decimals at any size.
    middle = (F.col("byte_offset") * 2 + F.col("size")).cast("decimal(28,0)") * F.lit(n_shards)
    placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(
        middle / F.lit(2 * total).cast("decimal(28,0)"))).cast("int"))
    placed = materialize(placed.select("id", "size", "crc", "shard", "rank", "byte_offset"))
    first = placed.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return placed.join(F.broadcast(first), "shard").select(  # one row per shard
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"), "byte_offset")
