"""Sinks: full refresh, replacing of goals, and latest-row reads."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_prepared(df: DataFrame, path: str, *metrics: Column) -> dict[str, Any]:
    """Full refresh of the prepared-visits table; returns the observed ``metrics``."""
    seen = Observation()
    (df.observe(seen, *metrics) if metrics else df).write.mode("overwrite").parquet(path)
    return seen.get if metrics else {}


def replace_goals(df: DataFrame, path: str, goals: Iterable[int], *metrics: Column) -> dict[str, Any]:
    """Replace the partitions of ``goals`` by their rows in ``df``; other goals stay.

    Goals of the list without rows in ``df`` lose their partition, so a rerun that finds
    nothing leaves nothing old behind; rows of goals that are not listed are not written. A goal
    with rows is swapped by Spark's dynamic partition overwrite: readers that list files while
    it commits may miss the goal for that moment. ``metrics`` are aggregates of what is
    written, observed on the way; they are returned by name.
    """
    wanted = sorted({int(g) for g in goals})
    seen = Observation()
    (df.where(F.col("goal_id").isin(wanted)).observe(seen, F.collect_set("goal_id").alias("_goals"), *metrics)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("goal_id").parquet(path))
    found = seen.get
    for goal in set(wanted) - {int(g) for g in found.pop("_goals", [])}:
        _drop_folder(df.sparkSession, f"{path}/goal_id={goal}")
    return found


def _drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def latest_by(df: DataFrame, keys: Sequence[str], version: str = "calculated_at") -> DataFrame:
    """Latest row per key by ``version`` (a replacing table read in its final state).

    A partial aggregate per executor keeps only one candidate row per key before
    the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*others), F.struct(version, *others)).alias("_row")
    return df.groupBy(*keys).agg(latest).select(*keys, "_row.*")
