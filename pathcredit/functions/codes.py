"""Column expressions for visit payloads and channel codes (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathcredit.constants import NON_SIGNIFICANT_ROOTS
from pathcredit.schema import TOUCH_FIELDS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def primary_touch(traffic_source: str | Column = "traffic_source") -> Column:
    """Struct of the first element with ``model = 1``; each field 0 when there is none."""
    first = F.get(F.filter(_col(traffic_source), lambda t: t["model"] == 1), 0)
    return F.struct(*[F.coalesce(first[f], F.lit(0)).alias(f) for f in TOUCH_FIELDS])


def source_code(touch: str | Column) -> Column:
    """Channel code ``root[_sub[_sub2]]`` from a primary-touch struct."""
    t = _col(touch)
    root = t["id"].cast("string")

    def sub(c: Column) -> Column:
        return F.concat(root, F.lit("_"), c.cast("string"))

    return (
        F.when(t["id"] == 2, sub(t["search_engine_root_id"]))
        .when((t["id"] == 3) & (t["adv_engine_id"] == 1) & (t["click_banner_id"] != 0),
              F.concat(sub(t["adv_engine_id"]), F.lit("_"), t["click_target_type"].cast("string")))
        .when(t["id"] == 3, sub(t["adv_engine_id"]))
        .when(t["id"] == 8, sub(t["social_network_id"]))
        .when(t["id"] == 9, sub(t["recommendation_system_id"]))
        .when(t["id"] == 10, sub(t["messenger_id"]))
        .otherwise(root)
    )


def goal_hits(goals: str | Column, goal_id: str | Column | int) -> Column:
    """How many times the goal was reached in the visit (repeats count)."""
    g = goal_id if isinstance(goal_id, Column) else (F.col(goal_id) if isinstance(goal_id, str) else F.lit(goal_id))
    return F.size(F.filter(_col(goals), lambda x: x["id"] == g)).cast("long")


def goal_revenue(goals: str | Column, goal_id: str | Column | int) -> Column:
    """Sum of the goal's prices in the visit, prices being stored times 1e6."""
    g = goal_id if isinstance(goal_id, Column) else (F.col(goal_id) if isinstance(goal_id, str) else F.lit(goal_id))
    hits = F.filter(_col(goals), lambda x: x["id"] == g)
    return F.aggregate(hits, F.lit(0.0), lambda acc, x: acc + x["price"]) / F.lit(1e6)


def root_id(code: str | Column) -> Column:
    """Leading number of a channel code, NULL when it is not a number."""
    return F.expr("try_cast(split_part({}, '_', 1) AS SMALLINT)".format(_sql(code)))


def sub_id(code: str | Column) -> Column:
    """Second part of a channel code as an integer, 0 when missing or not a number."""
    return F.coalesce(F.expr("try_cast(split_part({}, '_', 2) AS INT)".format(_sql(code))), F.lit(0))


def is_significant(code: str | Column) -> Column:
    r = root_id(code)
    return r.isNotNull() & ~r.isin(*NON_SIGNIFICANT_ROOTS)


def _sql(c: str | Column) -> str:
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError("pass a column name")
