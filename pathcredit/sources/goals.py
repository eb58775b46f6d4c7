"""Goal catalogue: which goals of a counter are usable for attribution."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.constants import ATTRIBUTION_GOAL_TYPES

_GOAL = "id long, name string, type string, is_retargeting int"

BUNDLED_CATALOGUE = os.path.join(os.path.dirname(__file__), "goals", "catalogue.json")


def read_goal_catalogue(spark: SparkSession, path: str = BUNDLED_CATALOGUE) -> DataFrame:
    """One row per goal of a catalogue document ``{"goals": [...]}``, none for an empty
    array; a document without a ``goals`` array is an error."""
    doc = spark.read.schema(f"goals array<struct<{_GOAL.replace(' ', ':').replace(',:', ',')}>>").option(
        "multiLine", "true").json(path)
    if doc.where(F.col("goals").isNotNull()).isEmpty():
        raise ValueError(f"no 'goals' array in {path}")
    return doc.select(F.explode("goals").alias("g")).select(
        F.col("g.id").alias("goal_id"), "g.name", "g.type",
        F.coalesce("g.is_retargeting", F.lit(0)).alias("is_retargeting"))


def usable_goals(catalogue: DataFrame, show_all: bool = False) -> DataFrame:
    """Drop retargeting goals and goal types that are not conversions, unless ``show_all``."""
    if show_all:
        return catalogue
    return catalogue.where((F.col("is_retargeting") != 1) & F.col("type").isin(*ATTRIBUTION_GOAL_TYPES))


def goal_by_name(catalogue: DataFrame, name: str) -> DataFrame:
    """The single goal whose trimmed name equals ``name`` ignoring case; none or several is an error."""
    hit = catalogue.where(F.lower(F.trim(F.col("name"))) == name.strip().lower())
    ids = [r.goal_id for r in hit.select("goal_id").orderBy("goal_id").collect()]
    if not ids:
        raise LookupError(f"no goal named {name!r} (case-insensitive exact match)")
    if len(ids) > 1:
        raise LookupError(f"multiple goals named {name!r}: ids {', '.join(map(str, ids))}")
    return hit


def goal_hits(raw: DataFrame, catalogue: DataFrame, show_all: bool = False) -> DataFrame:
    """Usable goals with how often each was reached in the raw deliveries."""
    hits = raw.select(F.explode("goals.id").alias("goal_id")).groupBy("goal_id").agg(F.count("*").alias("hits"))
    return usable_goals(catalogue, show_all).join(hits, "goal_id", "left").fillna(0, ["hits"])
