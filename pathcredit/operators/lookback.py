"""Credit models over look-back chains: one unit of credit per converting visit.

A chain is the run of a visitor's visits from the first one in the window to the
last one in the converting visit's second. No model builds (conversion, touch)
pairs: probe rows at the windows' two ends are ordered among the visits by the
chunked scan, and running values at the probes answer.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.constants import DEFAULT_HALF_LIFE_DAYS, DEFAULT_LOOKBACK_DAYS
from pathcredit.functions.codes import is_significant
from pathcredit.operators.scan import CHUNK, USER, chunk_rows, running

DAY = 86400
BEFORE, AT, AFTER = -1, 0, 1  # where a row stands among the visits of its second
PLACE = ("ts", "kind", "gidx")


def _credit(df: DataFrame, source: str | Column, value: Column) -> DataFrame:
    src = F.col(source) if isinstance(source, str) else source
    return df.groupBy("goal_id", src.alias("source_code")).agg(F.sum(value).cast("double").alias("credit"))


def _rows(df: DataFrame, ts: Column, kind: int, *more: Column) -> DataFrame:
    return df.select(*USER, ts.alias("ts"), F.lit(kind).alias("kind"), "gidx", *more)


def _placed(parts: list[DataFrame], specs: list[tuple], block: int | None = None) -> DataFrame:
    """Running values over visits and probes in order; ``block`` is the length of a segment in seconds."""
    rows = reduce(DataFrame.unionByName, parts)
    if block:
        rows = rows.withColumn("block", F.floor(F.col("ts") / block))
    return running(chunk_rows(rows, order=PLACE), specs, order=PLACE)


def chain_ends(touches: DataFrame, days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """One row per converting visit: the running indices of its chain's first and last visit, its time, and
    the last visit and the last significant visit up to its second as (gidx, source_code)."""
    conv = touches.where(F.col("c") > 0)
    ts, source = F.col("ts"), F.col("source_code")
    visit = F.when(F.col("n") == 1, F.struct("gidx", "source_code"))
    placed = _placed(
        [_rows(touches, ts, AT, source, F.lit(1).alias("n")),
         _rows(conv, ts - int(days) * DAY, BEFORE, source, F.lit(0).alias("n")),
         _rows(conv, ts, AFTER, source, F.lit(0).alias("n"))],
        [("upto", "sum", F.col("n"), False, []), ("last", "max", visit, False, []),
         ("significant", "max", F.when(is_significant("source_code"), visit), False, [])])
    end = F.col("kind") == AFTER
    return placed.where(F.col("kind") != AT).groupBy(*USER, F.col("gidx").alias("conv_gidx")).agg(
        (F.max(F.when(~end, F.col("upto"))) + 1).alias("first_gidx"),
        *[F.max(F.when(end, F.col(x))).alias(y) for x, y in (
            ("upto", "last_gidx"), ("ts", "conv_ts"), ("last", "last"), ("significant", "significant"))])


def lookback_first_touch(touches: DataFrame, ends: DataFrame) -> DataFrame:
    begun = ends.groupBy(*USER, F.col("first_gidx").alias("gidx")).agg(F.count("*").alias("chains"))
    return _credit(begun.join(touches.select(*USER, "gidx", "source_code"), [*USER, "gidx"]), "source_code", F.col("chains"))


def lookback_last_touch(touches: DataFrame) -> DataFrame:
    return _credit(touches.where(F.col("c") > 0), "source_code", F.lit(1.0))


def lookback_last_significant(ends: DataFrame) -> DataFrame:
    """Latest significant touch by position, else the touch at the last position."""
    inside = F.col("significant.gidx") >= F.col("first_gidx")
    return _credit(ends, F.when(inside, F.col("significant.source_code")).otherwise(F.col("last.source_code")), F.lit(1.0))


def lookback_linear(touches: DataFrame, ends: DataFrame, days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Every visit earns one part of each conversion in the window after it.

    With time cut into blocks of the window's length, that window is the rest of
    the visit's block and the beginning of the next one: a sum from the block's end at the
    visit, and one from the block's start at a probe. Credit is only ever added.
    """
    span, ts, nothing = int(days) * DAY, F.col("ts"), F.lit(0.0).alias("part")
    part = (1.0 / (F.col("last_gidx") - F.col("first_gidx") + 1)).alias("part")
    parts = [_rows(touches, ts, BEFORE, "source_code", nothing),
             _rows(ends.withColumn("gidx", F.col("conv_gidx")), F.col("conv_ts"), AT,
                   F.lit(None).cast("string").alias("source_code"), part)]
    if span:
        parts.append(_rows(touches, ts + span, AFTER, "source_code", nothing))
    placed = _placed(parts, [("rest", "rsum", F.col("part"), False, ["block"]),
                             ("begun", "sum", F.col("part"), False, ["block"])], max(span, 1))
    earned = F.when(F.col("kind") == BEFORE, F.col("rest")).otherwise(F.col("begun"))
    return _credit(placed.where((F.col("kind") != AT) & (earned > 0)), "source_code", earned)


#: Half-lives in a block of sums of powers: 2**400 and its square stay far inside the range of doubles.
_BLOCK = 400


def _decay_span(days: int, half_life: float) -> int:
    """Seconds of the window in which weights matter: beyond 400 half-lives (2**-400 of the converting visit's weight) none does."""
    return min(int(days) * DAY, max(1, math.ceil(_BLOCK * float(half_life) * DAY)))


def _power(seconds: Column, half_life: float) -> Column:
    return F.pow(F.lit(2.0), seconds / F.lit(float(half_life) * DAY))


def decay_norms(touches: DataFrame, days: int = DEFAULT_LOOKBACK_DAYS,
                half_life: float = DEFAULT_HALF_LIFE_DAYS) -> DataFrame:
    """(visitor, conv_gidx, conv_ts, norm): per converting visit the sum of its chain's weights, without pairs.

    A sliding sum of exponentials: time is cut into blocks as long as the window,
    weights are taken relative to their block's start, and the window is the rest of one
    block, read at a probe at its beginning, and the next block up to the converting
    visit's second, read at a probe there. Everything is added up, nothing subtracted.
    """
    span, ts, block = _decay_span(days, half_life), F.col("ts"), F.col("block")
    zero = F.lit(0.0).alias("w")
    conv = touches.where(F.col("c") > 0)
    weight = _power(ts - F.floor(ts / span) * span, half_life).alias("w")
    placed = _placed([_rows(touches, ts, AT, weight), _rows(conv, ts - span, BEFORE, zero), _rows(conv, ts, AFTER, zero)],
                     [("rest", "rsum", F.col("w"), False, ["block"]), ("begun", "sum", F.col("w"), False, ["block"])], span)
    at_start = F.col("kind") == BEFORE
    age = F.when(at_start, ts + span - block * span).otherwise(ts - block * span)  # from the block's start to the conversion
    part = F.when(at_start, F.col("rest")).otherwise(F.col("begun")) * _power(-age, half_life)
    return placed.where(F.col("kind") != AT).groupBy(*USER, F.col("gidx").alias("conv_gidx")).agg(
        F.max(F.when(~at_start, ts)).alias("conv_ts"), F.sum(part).alias("norm"))


def lookback_time_decay(touches: DataFrame, ends: DataFrame, days: int = DEFAULT_LOOKBACK_DAYS,
                        half_life: float = DEFAULT_HALF_LIFE_DAYS) -> DataFrame:
    """Weights ``2^(-days before the conversion / half_life)``, normalised per chain, without (conversion, touch) pairs.

    A visit earns its weight over the norm from each conversion in the window after it: the
    same two blocks as in :func:`decay_norms`, seen from the visit. Where the window is far longer than the
    half-life, visits beyond 400 half-lives earn 0; their sources still have a row.
    """
    if half_life <= 0:
        raise ValueError(f"half_life must be positive, got {half_life}")
    span, ts, block = _decay_span(days, half_life), F.col("ts"), F.col("block")
    if not span:  # chains of one second: all weights are equal
        return lookback_linear(touches, ends, days)
    norms = decay_norms(touches, days, half_life)
    nothing = F.lit(0.0).alias("part")
    source = F.col("source_code")
    share = (_power(-(F.col("conv_ts") - F.floor(F.col("conv_ts") / span) * span), half_life) / F.col("norm")).alias("part")
    placed = _placed(
        [_rows(touches, ts, BEFORE, source, nothing), _rows(touches, ts + span, AFTER, source, nothing),
         _rows(norms.withColumn("gidx", F.col("conv_gidx")), F.col("conv_ts"), AT,
               F.lit(None).cast("string").alias("source_code"), share)],
        [("rest", "rsum", F.col("part"), False, ["block"]), ("begun", "sum", F.col("part"), False, ["block"])], span)
    own = F.col("kind") == BEFORE
    age = F.when(own, ts - block * span).otherwise(ts - span - block * span)  # of the visit from the block's start
    earned = F.when(own, F.col("rest")).otherwise(F.col("begun")) * _power(age, half_life)
    credit = placed.where((F.col("kind") != AT) & (F.col("rest") + F.col("begun") > 0)).select(
        "goal_id", "source_code", earned.alias("credit")).where("credit > 0")
    if span < int(days) * DAY:
        credit = credit.unionByName(lookback_linear(touches, ends, days).select(
            "goal_id", "source_code", F.lit(0.0).alias("credit")))
    return _credit(credit, "source_code", F.col("credit"))


def lookback_assisted(touches: DataFrame, days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Each distinct source seen before the last position of a chain gets 1 per chain, without pairs.

    A source is counted at its last occurrence: a visit answers for the conversions from the
    next visit's second on, up to the window's end, but only until the visit after the source's next visit.
    Those are a difference of two running counts of conversions.
    """
    span = int(days) * DAY
    visits = running(touches.select(CHUNK, *USER, "gidx", "ts", "source_code"),
                     [("after", "next", F.struct("ts"), False, [])], order=("gidx",))
    visits = visits.select(*USER, "gidx", "ts", "source_code", F.col("after.ts").alias("next_ts"))
    by_source = [*USER, "source_code"]
    again = running(chunk_rows(visits, user=by_source, order=("gidx",)),
                    [("again", "next", F.struct("next_ts"), False, [])], by_source, ("gidx",))
    until = F.least(F.col("ts") + span, F.col("again.next_ts") - 1)  # nulls are ignored: not seen again, or last
    asked = again.select(*USER, "gidx", "source_code", "next_ts", until.alias("until")).where(F.col("next_ts") <= F.col("until"))
    none = F.lit(None).cast("string").alias("source_code")
    zero, source = F.lit(0).alias("n"), F.col("source_code")
    placed = _placed([_rows(touches.where(F.col("c") > 0), F.col("ts"), AT, none, F.lit(1).alias("n")),
                      _rows(asked, F.col("next_ts"), BEFORE, source, zero), _rows(asked, F.col("until"), AFTER, source, zero)],
                     [("upto", "sum", F.col("n"), False, [])])
    return _credit(placed.where(F.col("kind") != AT), "source_code", F.col("kind") * F.col("upto")).where("credit > 0")


def lookback_transitions(touches: DataFrame, days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Consecutive pairs of every look-back chain (one per occurrence).

    A visit and the one before it are a pair of every conversion from the visit's second on to
    the end of the window after the earlier one: a difference of two running counts.
    """
    until = F.col("prev_ts") + int(days) * DAY
    pairs = touches.where(until >= F.col("ts"))
    codes = (F.col("user_prev_source").alias("prev_source_code"), F.col("source_code").alias("next_source_code"))
    none = [F.lit(None).cast("string").alias(c) for c in ("prev_source_code", "next_source_code")]
    zero = F.lit(0).alias("n")
    placed = _placed([_rows(touches.where(F.col("c") > 0), F.col("ts"), AT, *none, F.lit(1).alias("n")),
                      _rows(pairs, F.col("ts"), BEFORE, *codes, zero), _rows(pairs, until, AFTER, *codes, zero)],
                     [("upto", "sum", F.col("n"), False, [])])
    return (placed.where(F.col("kind") != AT).groupBy("goal_id", "prev_source_code", "next_source_code")
            .agg(F.sum(F.col("kind") * F.col("upto")).cast("double").alias("transitions")).where("transitions > 0"))
