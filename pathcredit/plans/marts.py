"""Dashboard datasets and charts as DataFrame queries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.config import materialize
from pathcredit.constants import (
    DEFAULT_PERIOD_DAYS, DEFAULT_SELECTOR_MODEL, MIN_STEP_VISITS, TOP_SOURCES, TOP_TRANSITIONS,
)
from pathcredit.functions.names import model_name


def kpi_touchpoints(touches: DataFrame, goal_id: int | None = None, start: date | None = None,
                    end: date | None = None) -> DataFrame:
    """Converting chains and their average number of touches (a chain's touches = its position),
    of the chains ending between ``start`` and ``end`` if given."""
    t = touches.where(F.col("c") > 0)
    if goal_id is not None:
        t = t.where(F.col("goal_id") == goal_id)
    if start is not None:
        t = t.where(F.col("chain_date") >= F.lit(start))
    if end is not None:
        t = t.where(F.col("chain_date") <= F.lit(end))
    return t.agg(F.count("*").alias("converting_chains"), F.avg("pos").alias("avg_touchpoints"))


def chain_steps(touches: DataFrame, min_visits: int = MIN_STEP_VISITS, goal_id: int | None = None) -> DataFrame:
    """Step-indexed edges (from, to, step) over all chains: chains containing the edge at that
    step and their conversions; edges seen in fewer than ``min_visits`` chains are dropped.

    The edge ending at session position p sits in every chain i ≥ p of the session:
    the touch table's counts from each visit to its session's end, added up by edge
    before anything moves.
    """
    t = touches if goal_id is None else touches.where(F.col("goal_id") == goal_id)
    return (t.where(F.col("pos") >= 2)
            .groupBy(F.col("prev_source").alias("from_channel"), F.col("source_code").alias("to_channel"),
                     (F.col("pos") - 1).alias("step"))
            .agg(F.sum("ssuf_n").alias("visits"), F.sum("ssuf_c").alias("conversions"))
            .where(F.col("visits") >= min_visits)
            .orderBy("step", F.desc("visits"), "from_channel", "to_channel"))


def channel_ratios(named: DataFrame) -> DataFrame:
    """Ratios of sums per model and channel; a zero denominator gives NULL."""
    g = named.groupBy("attribution_type", "source_code", "source_name").agg(
        F.sum("visits").alias("visits"), F.sum("conversions").alias("conversions"),
        F.sum("revenue").alias("revenue"))
    return g.select("*",
                    F.try_divide("conversions", "visits").alias("conversion_rate"),
                    F.try_divide("revenue", "visits").alias("revenue_per_visit"),
                    F.try_divide("revenue", "conversions").alias("revenue_per_conversion"))


def top_ranked(df: DataFrame, dims: Sequence[str], among: Sequence[str], measure: str, n: int) -> DataFrame:
    """Aggregate ``measure`` over ``dims``, dense-rank the ``among`` values by it descending
    within the other dimensions, keep ranks ≤ n, largest first.

    Without other dimensions the n largest different totals are found first (partial
    top-n per task), and ranks given only to the rows that reach them.
    """
    g = df.groupBy(*dims).agg(F.sum(measure).alias(measure))
    others = [d for d in dims if d not in among]
    if others:
        w = Window.partitionBy(*others).orderBy(F.desc(measure))
        top = g.withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= n)
    else:
        g = materialize(g)
        levels = [r[0] for r in g.select(measure).distinct().orderBy(F.desc(measure)).limit(n).collect()]
        rank = F.array_position(F.array(*[F.lit(x) for x in levels]), F.col(measure)) if levels else F.lit(0)
        top = g.withColumn("rank", rank.cast("int")).where(F.col("rank") > 0)
    return top.orderBy(*others, "rank", *among)


def top_sources(named: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    """Channels ranked by conversions within each model."""
    return top_ranked(named, ["attribution_type", "source_name"], ["source_name"], "conversions", n)


def top_transitions(named_trans: DataFrame, n: int = TOP_TRANSITIONS) -> DataFrame:
    """Transition pairs ranked by occurrences over the whole matrix."""
    return top_ranked(named_trans, ["prev_source_name", "next_source_name"],
                      ["prev_source_name", "next_source_name"], "transitions", n)


def model_names(results: DataFrame) -> DataFrame:
    return results.groupBy("attribution_type").agg(F.count("*").alias("rows")).select(
        "attribution_type", model_name(F.col("attribution_type")).alias("model_name"), "rows")


def kpi_linear(named: DataFrame) -> DataFrame:
    lin = named.where(F.col("attribution_type") == "linear")
    return lin.agg(F.sum("revenue").alias("revenue"), F.sum("conversions").alias("conversions"))


def model_mix(named: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    """Share of each top channel within its model (the 100 % stacked chart)."""
    top = top_sources(named, n)
    w = Window.partitionBy("attribution_type")
    return top.withColumn("share", F.try_divide(F.col("conversions"), F.sum("conversions").over(w))).orderBy(
        "attribution_type", F.desc("conversions"), "source_name")


def source_time_series(named: DataFrame, model: str = DEFAULT_SELECTOR_MODEL, n: int = TOP_SOURCES) -> DataFrame:
    """Daily conversions of the top channels of one model, by date ascending."""
    m = named.where(F.col("attribution_type") == model)
    return top_ranked(m, ["start_date", "source_name"], ["source_name"], "conversions", n) \
        .orderBy("start_date", "rank", "source_name")


def source_by_model(named: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    """Top channels × models with display names, by conversions descending."""
    return top_sources(named, n).withColumn("model_name", model_name(F.col("attribution_type"))).orderBy(
        F.desc("conversions"), "attribution_type", "source_name")


def direct_vs_assisted(assisted_long: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    return top_ranked(assisted_long, ["source_name", "metric_type"], ["source_name"], "value", n).orderBy(
        F.desc("value"), "source_name", "metric_type")


def transition_matrix(named_trans: DataFrame, n: int = TOP_TRANSITIONS) -> DataFrame:
    """Top pairs as a matrix with row totals, column totals and the grand total (NULL = total)."""
    top = top_transitions(named_trans, n)
    return top.cube("prev_source_name", "next_source_name").agg(
        F.sum("transitions").alias("transitions"),
        F.grouping_id().alias("total_level")).orderBy(
            F.desc("transitions"), "total_level", "prev_source_name", "next_source_name")


def source_model_pivot(named: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    """Channel × model pivot of visits, conversions, revenue, revenue per conversion, with totals."""
    g = named.groupBy("attribution_type", "source_name").agg(
        F.sum("visits").alias("visits"), F.sum("conversions").alias("conversions"),
        F.sum("revenue").alias("revenue"))
    keep = top_sources(named, n).select("attribution_type", "source_name")
    top = g.join(keep, ["attribution_type", "source_name"]).withColumn(
        "model_name", model_name(F.col("attribution_type")))
    return top.cube("source_name", "model_name").agg(
        F.sum("visits").alias("visits"), F.sum("conversions").alias("conversions"),
        F.sum("revenue").alias("revenue"),
        F.try_divide(F.sum("revenue"), F.sum("conversions")).alias("revenue_per_conversion"),
        F.grouping_id().alias("total_level")).orderBy(
            F.desc("conversions"), "total_level", "source_name", "model_name")


def selector_filter(named: DataFrame, as_of: date | None = None, days: int = DEFAULT_PERIOD_DAYS,
                    model: str | None = DEFAULT_SELECTOR_MODEL, sources: Sequence[str] | None = None) -> DataFrame:
    """Dashboard selectors: the last ``days`` days up to ``as_of`` (default: latest date in
    the data), one model, any set of channel names (None = all)."""
    end = F.lit(as_of) if as_of is not None else named.select(F.max("start_date")).scalar()
    out = named.where((F.col("start_date") > F.date_sub(end, days)) & (F.col("start_date") <= end))
    if model is not None:
        out = out.where(F.col("attribution_type") == model)
    if sources:
        out = out.where(F.col("source_name").isin(list(sources)))
    return out
