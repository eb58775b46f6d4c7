"""Incremental landing of raw deliveries with Structured Streaming.

New snapshot files dropped into a folder are appended to the weekly-partitioned
raw store. ``trigger(availableNow=True)`` processes whatever has arrived and
stops, which fits a daily schedule. A batch may be delivered again after a
failure, so each batch overwrites a folder of its own, named by its id: a
repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathcredit.schema import raw_schema
from pathcredit.sources.visits import write_raw


def ingest_raw(spark: SparkSession, landing_dir: str, raw_path: str, checkpoint: str,
               available_now: bool = True, unsigned: bool = False):
    """Starts the stream; ``unsigned`` for files whose visitor, visit and banner ids are unsigned 64-bit numbers."""
    stream = spark.readStream.schema(raw_schema(unsigned)).parquet(landing_dir)

    def land(batch: DataFrame, epoch: int) -> None:
        write_raw(batch, f"{raw_path}/batch={epoch}", mode="overwrite")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()
