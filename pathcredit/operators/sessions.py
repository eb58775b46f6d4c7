"""Step 2: inter-visit gaps, adaptive session timeout, sessions and their markers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.constants import DEFAULT_TIMEOUT_SECONDS, TIMEOUT_QUANTILE
from pathcredit.operators.scan import CHUNK, ORDER, START, USER, chunk_rows, local_window, rows_of_spanning


def with_ts(prepared: DataFrame) -> DataFrame:
    return prepared.withColumn("ts", F.unix_seconds("utc_start_time"))


def _chunked(prepared: DataFrame, n_chunks: int | None, user: Sequence[str] = USER) -> DataFrame:
    """Prepared visits tagged with their chunk plus local order, previous local time."""
    w = local_window(user)
    return (chunk_rows(with_ts(prepared), n_chunks, user)
            .withColumn("_rn", F.row_number().over(w))
            .withColumn("_lag", F.lag("ts").over(w)))


def _chunk_bounds(local: DataFrame, user: Sequence[str] = USER) -> DataFrame:
    """Per (chunk, visitor) of visitors in several chunks: first/last time, rows, and the previous chunk's last time."""
    s = rows_of_spanning(local).groupBy(CHUNK, *user).agg(F.min("ts").alias("_first_ts"), F.max("ts").alias("_last_ts"),
                                         F.count("*").alias("_n"),
                                         F.min(F.struct(*ORDER)).alias(START)).repartition(*user)
    return s.withColumn("_prev_last_ts", F.lag("_last_ts").over(Window.partitionBy(*user).orderBy(START)))


def _gaps(local: DataFrame, bounds: DataFrame) -> DataFrame:
    goal = ["goal_id"] if "goal_id" in local.columns else []
    inner = local.where(F.col("_rn") > 1).select(*goal, (F.col("ts") - F.col("_lag")).alias("gap"))
    first = bounds.where(F.col("_prev_last_ts").isNotNull()).select(
        *goal, (F.col("_first_ts") - F.col("_prev_last_ts")).alias("gap"))
    return inner.unionByName(first)


#: Bits of a whole number that its bin leaves out in :func:`quantile_row`.
BIN_BITS = 16


def quantile_row(values: DataFrame, column: str, quantile: float) -> DataFrame:
    """One lazy row (value): the interpolated quantile of a whole-number column, null without values.

    Values are counted, the counts summed by bins of 2**16 neighbouring values, and the bins ranked by a running
    sum (seconds up to a century fill some 50,000 of them); only the one or two bins that hold the
    two wanted ranks, of at most 65,536 distinct values each, are ranked inside. No task
    ever holds all distinct values, and nothing runs until the row is asked for.
    """
    v, n = F.col(column), F.col("n")
    counts = values.where(v.isNotNull()).groupBy(v.cast("long").alias("v")).agg(F.count("*").alias("n")).withColumn(
        "bin", F.shiftright("v", BIN_BITS))
    sums = counts.groupBy("bin").agg(F.sum("n").alias("n"))
    rank = F.lit(float(quantile)) * (F.col("size") - 1)
    sums = sums.select("bin", (F.sum("n").over(Window.orderBy("bin")) - n).alias("before"), n,
                       F.sum("n").over(Window.partitionBy()).alias("size")).withColumn("rank", rank)
    low = F.floor("rank")
    high = F.least(low + 1, F.col("size") - 1)
    held = sums.where((F.col("before") + n > low) & (F.col("before") <= high)).drop("n")
    inside = counts.join(F.broadcast(held), "bin").withColumn(
        "upto", F.col("before") + F.sum("n").over(Window.partitionBy("bin").orderBy("v")))
    ends = inside.agg(F.min(F.when(F.col("upto") > low, F.col("v"))).alias("a"),
                      F.min(F.when(F.col("upto") > high, F.col("v"))).alias("b"), F.max("rank").alias("rank"))
    return ends.select((F.col("a") + (F.col("rank") - F.floor("rank")) * (F.col("b") - F.col("a"))).alias("value"))


def timeout_row(gaps: DataFrame, quantile: float = TIMEOUT_QUANTILE, default: int = DEFAULT_TIMEOUT_SECONDS) -> DataFrame:
    """One lazy row (timeout_seconds): integer part of the exact quantile of positive gaps, else ``default``.

    Visits that repeat per goal count once: only the smallest goal's copy.
    """
    if "goal_id" in gaps.columns:
        gaps = gaps.where(F.col("goal_id") == gaps.select(F.min("goal_id")).scalar())
    whole = F.floor("value").cast("long")
    return quantile_row(gaps.where(F.col("gap") > 0), "gap", quantile).select(
        F.when(whole > 0, whole).otherwise(F.lit(default).cast("long")).alias("timeout_seconds"))


def visit_gaps(prepared: DataFrame, n_chunks: int | None = None) -> DataFrame:
    """Each visit with the previous visit's time in its visitor's history and the gap in seconds."""
    local = _chunked(prepared, n_chunks)
    bounds = _chunk_bounds(local).select(CHUNK, *USER, "_prev_last_ts")
    df = local.join(F.broadcast(bounds), [CHUNK, *USER], "left")
    prev = F.when(F.col("_rn") == 1, F.col("_prev_last_ts")).otherwise(F.col("_lag"))
    return (df.withColumn("prev_ts", prev).withColumn("gap", F.col("ts") - F.col("prev_ts"))
            .drop("_rn", "_lag", "_prev_last_ts"))


def session_timeout(prepared: DataFrame, quantile: float = TIMEOUT_QUANTILE,
                    default: int = DEFAULT_TIMEOUT_SECONDS, n_chunks: int | None = None) -> DataFrame:
    """The learned timeout as a one-row table."""
    local = _chunked(prepared, n_chunks)
    return timeout_row(_gaps(local, _chunk_bounds(local)), quantile, default)


def sessionize(prepared: DataFrame, timeout: int | Column | None = None, n_chunks: int | None = None,
               quantile: float = TIMEOUT_QUANTILE, user: Sequence[str] = USER) -> DataFrame:
    """Session id (1-based per visitor) and position of every visit; ``user`` tells visitors apart.

    A new session starts at a visitor's first visit and after any gap strictly
    longer than the timeout. ``timeout=None`` learns it from the data (one scalar
    job); a Column keeps it inside the plan. One local window pass, and one summary row per chunk of visitors in
    several chunks, give every row its previous time, session id and position; rows keep the chunk layout.
    """
    local = _chunked(prepared, n_chunks, user)
    bounds = _chunk_bounds(local, user)
    if timeout is None:
        # One number, computed once over the chunk-local gaps; every later stage
        # then compares against a literal instead of re-planning a subquery.
        timeout = F.lit(timeout_row(_gaps(local, bounds), quantile).first()[0])
    elif not isinstance(timeout, Column):
        timeout = F.lit(int(timeout))
    T = timeout.cast("long")

    local_start = (F.col("_rn") > 1) & (F.col("ts") - F.col("_lag") > T)
    inner = rows_of_spanning(local).groupBy(CHUNK, *user).agg(
        F.sum(local_start.cast("long")).alias("_starts"),
        F.max(F.when(local_start, F.col("_rn"))).alias("_last_start_rn"),
    )
    s = bounds.join(inner, [CHUNK, *user])
    wu = Window.partitionBy(*user).orderBy(START)
    first_start = F.col("_prev_last_ts").isNull() | (F.col("_first_ts") - F.col("_prev_last_ts") > T)
    s = s.withColumn("_first_start", first_start)
    s = s.withColumn("_grp_starts", F.col("_starts") + F.col("_first_start").cast("long"))
    s = s.withColumn("_carry_sid", F.coalesce(
        F.sum("_grp_starts").over(wu.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # Rows of the session still open at the end of each chunk, accumulated over
    # consecutive chunks without a session start.
    tail = (F.when(F.col("_last_start_rn").isNotNull(), F.col("_n") - F.col("_last_start_rn") + 1)
            .otherwise(F.col("_n")))
    s = s.withColumn("_block", F.sum((F.col("_grp_starts") > 0).cast("long")).over(
        wu.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("_open", F.sum(tail).over(
        Window.partitionBy(*user, "_block").orderBy(START).rowsBetween(Window.unboundedPreceding, 0)))
    s = s.select(CHUNK, *user, "_prev_last_ts", "_first_start", "_carry_sid",
                 F.lag("_open").over(wu).alias("_carry_pos"))

    # Visitors within one chunk take nothing from others and have no row here.
    df = local.join(F.broadcast(s), [CHUNK, *user], "left")
    first = F.col("_rn") == 1
    prev = F.when(first, F.col("_prev_last_ts")).otherwise(F.col("_lag"))
    gap = F.col("ts") - prev
    start = F.when(first, F.coalesce("_first_start", F.lit(True))).otherwise(gap > T)
    df = df.select("*", prev.alias("prev_ts"), gap.alias("gap"), T.alias("timeout_seconds"),
                   start.alias("is_start"))
    w = local_window(user)
    df = df.select("*", F.sum(F.col("is_start").cast("long")).over(w).alias("_loc_starts"),
                   F.max(F.when(F.col("is_start"), F.col("_rn"))).over(w).alias("_loc_start_rn"))
    pos = (F.when(F.col("_loc_start_rn").isNotNull(), F.col("_rn") - F.col("_loc_start_rn") + 1)
           .otherwise(F.col("_carry_pos") + F.col("_rn")))
    drop = {"_rn", "_lag", "_prev_last_ts", "_first_start", "_carry_sid", "_carry_pos",
            "_loc_starts", "_loc_start_rn"}
    return df.select(*[c for c in df.columns if c not in drop],
                     (F.coalesce("_carry_sid", F.lit(0)) + F.col("_loc_starts")).alias("session_id"), pos.alias("pos"))


def session_breaks(sessions: DataFrame) -> DataFrame:
    """Break markers: one per gap longer than the timeout, at earlier visit + timeout."""
    return sessions.where(F.col("is_start") & F.col("prev_ts").isNotNull()).select(
        *USER,
        F.timestamp_seconds(F.col("prev_ts") + F.col("timeout_seconds")).alias("marker_time"),
        F.col("visit_id").alias("next_visit_id"),
        F.col("gap").alias("gap_seconds"),
    )


def user_last_close(sessions: DataFrame) -> DataFrame:
    """Closing marker of every visitor: last visit time + timeout."""
    return sessions.groupBy(*USER).agg(
        F.timestamp_seconds(F.max("ts") + F.max("timeout_seconds")).alias("marker_time"),
        F.count("*").alias("visits"),
    )


def event_timeline(sessions: DataFrame) -> DataFrame:
    """Visits and both marker kinds as one flat timeline per visitor, with each row's ``position`` in
    the order (time, type, visit id).

    Marker rows have type ``0_NULL`` and sort before a visit (``2_VISIT``) at the
    same second, as in the marker formulation of sessions. ``sessions`` is the
    touch table: a visit stands after ``gidx - 1`` visits and one break for every
    session before its own, a break right before the visit that starts the next
    session, and the closing marker last, so no further ordered pass is needed.
    """
    at = F.col("gidx") + F.col("session_id") - 1
    id_type = sessions.schema["visit_id"].dataType

    def rows(df: DataFrame, time: Column, position: Column, *what: Column) -> DataFrame:
        return df.select(*USER, time.alias("event_time"), *what, position.alias("position"))

    marker = [F.lit("0_NULL").alias("event_type"), F.lit(0).cast(id_type).alias("visit_id"),
              F.lit("null").alias("source_code")]
    visits = rows(sessions, F.col("utc_start_time"), at, F.lit("2_VISIT").alias("event_type"), F.col("visit_id"),
                  F.col("source_code"))
    breaks = rows(sessions.where(F.col("is_start") & F.col("prev_ts").isNotNull()),
                  F.timestamp_seconds(F.col("prev_ts") + F.col("timeout_seconds")), at - 1, *marker)
    last = sessions.groupBy(*USER).agg(F.max("ts").alias("ts"), F.max("timeout_seconds").alias("timeout"),
                                       F.max(at).alias("at"))
    closes = rows(last, F.timestamp_seconds(F.col("ts") + F.col("timeout")), F.col("at") + 1, *marker)
    return visits.unionByName(breaks).unionByName(closes)
