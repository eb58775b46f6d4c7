"""Step 1: collapse versioned deliveries into live visits and derive the channel code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.functions.codes import goal_hits, goal_revenue, primary_touch, source_code
from pathcredit.schema import VISIT_KEY

PAYLOAD = ("utc_start_time", "duration", "traffic_source", "goals", "purchases")


def collapse(raw: DataFrame) -> DataFrame:
    """One row per live visit: groups with ``sum(sign) > 0``, payload of the latest version.

    One ``max_by`` over a struct replaces a per-field arg-max; ties on the version
    are broken by the sign, so a cancel row never wins over its own re-delivery.
    The aggregation is partial (map-side) before the shuffle on the visit key.
    """
    payload = [c for c in PAYLOAD if c in raw.columns]
    latest = F.max_by(F.struct(*payload), F.struct("visit_version", "sign"))
    return (
        raw.groupBy(*VISIT_KEY)
        .agg(F.sum("sign").alias("_signs"), latest.alias("_latest"),
             F.max("visit_version").alias("visit_version"))
        .where(F.col("_signs") > 0)
        .select(*VISIT_KEY, "visit_version", "_latest.*")
    )


def flatten_touch(live: DataFrame) -> DataFrame:
    """Primary touch fields and the channel code of every live visit."""
    return (live.withColumn("_touch", primary_touch("traffic_source"))
            .withColumn("source_code", source_code("_touch")))


def live_visits(raw: DataFrame, counter_id: int | None, goal_ids: int | Iterable[int]) -> DataFrame:
    """One row per live visit, whatever the number of goals: channel code and ``goals``, each goal's conversions
    and revenue.

    Channel code, goal hits and revenue are derived per delivery before the
    collapse, so the shuffle on the visit key carries a few scalars instead of
    the nested arrays; the latest version's values are the same either way.
    """
    if counter_id is not None:
        raw = raw.where(F.col("counter_id") == F.lit(int(counter_id)))
    goals = [int(goal_ids)] if isinstance(goal_ids, int) else [int(g) for g in goal_ids]
    each = F.array(*[F.struct(F.lit(g).cast("long").alias("goal_id"),
                              goal_hits("goals", g).alias("conversions"),
                              goal_revenue("goals", g).alias("revenue")) for g in goals])
    flat = raw.select(
        *VISIT_KEY, "visit_version", "sign", "utc_start_time", "duration",
        source_code(primary_touch("traffic_source")).alias("source_code"), each.alias("goals"),
    )
    latest = F.max_by(F.struct("utc_start_time", "duration", "source_code", "goals"),
                      F.struct("visit_version", "sign"))
    return (flat.groupBy(*VISIT_KEY).agg(F.sum("sign").alias("_signs"), latest.alias("_l"))
            .where(F.col("_signs") > 0).select(*VISIT_KEY, "_l.*"))


def per_goal(visits: DataFrame) -> DataFrame:
    """One row per (goal, visit) of :func:`live_visits`, or of any table with its columns, in place of ``goals``.

    Nothing moves: visits laid out by chunk stay so.
    """
    others = [c for c in visits.columns if c not in ("goals", *VISIT_KEY)]
    return visits.select(*VISIT_KEY, *others, F.explode("goals").alias("_g")).select(
        "_g.goal_id", *VISIT_KEY, *others, "_g.conversions", "_g.revenue")


def prepare_visits(raw: DataFrame, counter_id: int | None, goal_ids: int | Iterable[int]) -> DataFrame:
    """Prepared visits: one row per (goal, live visit) with code, conversions and revenue."""
    return per_goal(live_visits(raw, counter_id, goal_ids))
