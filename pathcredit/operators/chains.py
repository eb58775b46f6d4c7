"""Chain tables: session prefix chains (the exported ``visits_combined`` shape, stored with shared
prefixes) and fixed look-back chains of converting visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.operators.scan import CHUNK, USER

SESSION = [*USER, "session_id"]
#: Touches in a stored array, at most.
BLOCK = 256


def chain_ends(sessions: DataFrame) -> DataFrame:
    """One row per visit, the end of a chain: its session and how many of the session's touches the chain has."""
    return sessions.select(
        *SESSION, F.col("pos").alias("chain_length"), "visit_id", F.to_date("utc_start_time").alias("start_date"),
        F.col("conversions").cast("double").alias("conversions"), F.col("revenue").cast("double").alias("revenue"))


def touch_blocks(sessions: DataFrame, size: int = BLOCK) -> DataFrame:
    """Every touch of a session once, in arrays of at most ``size`` consecutive touches.

    All chains of a session are prefixes of it, so this and :func:`chain_ends` hold them all:
    linear, where an array per chain is quadratic. Blocks are built inside the chunks of the ordered scan
    (a block that reaches over a chunk's end is stored as two), so nothing is
    shuffled and no task holds a whole session.
    """
    touch = F.struct("pos", "visit_id", "source_code", "utc_start_time", F.lit("2_VISIT").alias("event_type"),
                     F.col("conversions").cast("double").alias("conversions"))
    blocks = sessions.groupBy(CHUNK, *SESSION, F.floor((F.col("pos") - 1) / size).alias("_block")).agg(
        F.array_sort(F.collect_list(touch)).alias("touches"))
    return blocks.select(*SESSION, F.col("touches")[0]["pos"].alias("first_pos"), "touches")


def read_chains(ends: DataFrame, blocks: DataFrame) -> DataFrame:
    """The chains that end in ``ends``, each with its ``history`` of touches as one array.

    As large as the chains asked for: filter ``ends`` first. A chain meets only its own session's blocks up
    to its end.
    """
    parts = ends.join(blocks, SESSION).where(F.col("first_pos") <= F.col("chain_length"))
    part = F.slice("touches", F.lit(1), (F.col("chain_length") - F.col("first_pos") + 1).cast("int"))
    whole = F.array_sort(F.collect_list(F.struct("first_pos", part.alias("part"))))
    return (parts.groupBy(*ends.columns).agg(whole.alias("_parts"))
            .withColumn("history", F.flatten(F.col("_parts.part"))).drop("_parts"))


def build_chains(sessions: DataFrame) -> DataFrame:
    """One row per visit with the session prefix ending at it as ``history`` (see :func:`read_chains`)."""
    return read_chains(chain_ends(sessions), touch_blocks(sessions))


def chain_paths(chains: DataFrame) -> DataFrame:
    """Flat, comparable view of the chain table: length and the five arrays of a chain, each joined by ' > '."""
    def joined(field: str, of=lambda x: x) -> Column:  # noqa: ANN001
        return F.concat_ws(" > ", F.transform("history", lambda t: of(t[field]).cast("string")))
    return chains.select(
        *USER, "visit_id", "start_date", F.size("history").cast("long").alias("chain_length"),
        joined("source_code").alias("path"), joined("visit_id").alias("visit_ids"),
        joined("utc_start_time", F.unix_seconds).alias("times"), joined("event_type").alias("event_types"),
        joined("conversions", lambda c: c.cast("long")).alias("touch_conversions"), "conversions", "revenue",
    )


#: Running indices in a block of the interval join.
INDEX_BLOCK = 64


def lookback_chains(touches: DataFrame, ends: DataFrame) -> DataFrame:
    """For every converting visit, all visits of the same visitor in its window, from ``ends`` (see ``lookback.chain_ends``).

    Both ends of the window are inclusive, also for visits in the same second. A chain is an interval of the
    visitor's running visit indices, so positions and lengths need no aggregation. It is
    expanded to the blocks of indices it covers, equi-joined with visits on (visitor, block); only
    the two end blocks hold visits that are then left out. A chain's key is its converting visit's running
    index: one visit id may convert on several dates.
    """
    v = touches.select(*USER, F.floor(F.col("gidx") / INDEX_BLOCK).alias("_block"), "visit_id", "ts", "gidx",
                       "source_code", "user_prev_source")
    conv = touches.where(F.col("c") > 0).select(*USER, F.col("visit_id").alias("conv_visit_id"), F.col("gidx").alias("conv_gidx"))
    first, last = (F.floor(F.col(c) / INDEX_BLOCK) for c in ("first_gidx", "last_gidx"))
    blocks = conv.join(ends.select(*USER, "conv_gidx", "conv_ts", "first_gidx", "last_gidx"), [*USER, "conv_gidx"]).withColumn(
        "_block", F.explode(F.sequence(first, last)))
    pairs = blocks.join(v, [*USER, "_block"]).where(F.col("gidx").between(F.col("first_gidx"), F.col("last_gidx")))
    return pairs.select(
        *USER, "conv_visit_id", "conv_gidx", "visit_id", "source_code", "user_prev_source",
        (F.col("gidx") - F.col("first_gidx") + 1).alias("position"),
        (F.col("last_gidx") - F.col("first_gidx") + 1).alias("chain_length"),
        ((F.col("conv_ts") - F.col("ts")) / 86400.0).alias("days_before_conv"),
        (F.col("gidx") == F.col("conv_gidx")).cast("int").alias("is_converting"),
    )
