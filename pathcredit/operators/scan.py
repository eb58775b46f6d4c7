"""Ordered per-visitor scans that stay balanced when one visitor holds a large
share of all visits.

``Window.partitionBy(user)`` sends a visitor's whole history to one task. Here the
visits are range-partitioned on (visitor, time, visit id) instead, so Spark's
sampled bounds cut a heavy visitor's history into several contiguous chunks of
similar size. The chunk of every row is checkpointed once, which fixes the
assignment for every later use. Running aggregates are windows per
(chunk, visitor). Only a visitor whose rows reach over a chunk's end takes anything from
another chunk, at most one at each end; these visitors' rows alone are summarised, and the
summary, a few rows per chunk, is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathcredit.config import materialize

CHUNK = "_chunk"
START = "_chunk_start"  # first (order) key of a user's rows in a chunk: orders a user's chunks
VISITOR = ("counter_id", "user_id")
USER = ("goal_id", *VISITOR)
RANGED_BY = "ranged_by"  # metadata of the chunk column: the columns that tell users apart in the rows' ranges
ORDER = ("ts", "visit_id", "start_date")  # one visit id may be live on two dates

_AGG = {"sum": F.sum, "rsum": F.sum, "max": F.max, "min": F.min}


def chunk_rows(df: DataFrame, n_chunks: int | None = None,
               user: Sequence[str] = USER, order: Sequence[str] = ORDER) -> DataFrame:
    """Range-partition rows on (user, order) into ``n_chunks``, tag the chunk, and write
    the rows as a table bucketed by chunk.

    Range bounds come from a sample of the input; writing makes the assignment
    a fact rather than something recomputed (and possibly re-sampled). Each
    chunk's label is chosen to hash into the chunk's own bucket, so every range
    task writes exactly one bucket with no further shuffle, and every later
    per-(chunk, user) window, summary and join reads the rows in place, one
    chunk per task. A user's chunks are ordered by their first row, not by label.
    """
    spark = df.sparkSession
    n = n_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *user, *order).withColumn("_part", F.spark_partition_id())
    tagged = ranged.join(F.broadcast(chunk_labels(spark, n)), "_part").drop("_part")
    tagged = tagged.withColumn(CHUNK, F.col(CHUNK).alias(CHUNK, metadata={RANGED_BY: list(user)}))
    return materialize(tagged, layout(user), n, arranged=True)


def chunk_labels(spark: SparkSession, n: int) -> DataFrame:
    """``(_part, _chunk)`` for ``n`` buckets: for each bucket the smallest non-negative
    int whose bucket (Spark's hash modulo ``n``, as ``bucketBy`` uses) is that bucket.

    One row per bucket, so the broadcast is bounded by the bucket count; 64·n
    candidates leave a bucket unhit with probability about n·e^-64.
    """
    if n not in _LABELS:
        candidates = spark.range(0, 64 * n).select(F.col("id").cast("int").alias(CHUNK))
        rows = (candidates.groupBy(F.pmod(F.hash(CHUNK), F.lit(n)).alias("_part"))
                .agg(F.min(CHUNK).alias(CHUNK)).collect())
        if len(rows) != n:
            raise RuntimeError(f"no chunk label found for {n - len(rows)} of {n} buckets")
        _LABELS[n] = sorted((r["_part"], r[CHUNK]) for r in rows)
    return spark.createDataFrame(_LABELS[n], f"_part int, {CHUNK} int")


_LABELS: dict[int, list[tuple[int, int]]] = {}


def layout(user: Sequence[str] = USER) -> list[str]:
    """Bucket columns of every table in the chunk layout: hash of the chunk label alone,
    which also satisfies every window, aggregate and join keyed by (chunk, user, ...)."""
    return [CHUNK]


def local_window(user: Sequence[str] = USER, order: Sequence[str] = ORDER, extra: Sequence[str] = ()):
    return Window.partitionBy(CHUNK, *user, *extra).orderBy(*[F.col(c) for c in order])


def spanning(df: DataFrame) -> DataFrame:
    """The users that have rows in several chunks: fewer than there are chunks, for each is the first or last user of
    its chunks. Users as the rows were ranged: where goals became rows inside the chunks, visitors."""
    by = df.schema[CHUNK].metadata[RANGED_BY]
    ends = df.groupBy(CHUNK).agg(F.min(F.struct(*by)).alias("_a"), F.max(F.struct(*by)).alias("_b"))
    # One row per chunk, in the ranges' order: a chunk's last user goes on where the next chunk begins with the same.
    ends = ends.withColumn("_next", F.lead("_a").over(Window.orderBy("_a", "_b")))
    return ends.where(F.col("_b") == F.col("_next")).select("_b.*").distinct()


def rows_of_spanning(df: DataFrame) -> DataFrame:
    """The rows of the users that have rows in several chunks."""
    users = spanning(df)
    return df.join(F.broadcast(users), users.columns, "left_semi")


def running(df: DataFrame, specs: Sequence[tuple], user: Sequence[str] = USER,
            order: Sequence[str] = ORDER, across: DataFrame | None = None) -> DataFrame:
    """Add running aggregates within contiguous segments of each user's ordered rows.

    Each spec is ``(name, kind, column, exclusive, segment)``: ``kind`` is
    ``sum``/``max``/``min`` over the rows up to this one, ``rsum``, the sum
    over this and all later rows (added up from the end, so a tail of zeros is exactly 0), or ``next``, the
    value of the user's next row (never null itself; null after the last one; no segment);
    ``segment`` lists columns (beyond ``user``) whose
    values never decrease along the order, so each value is one contiguous run
    of rows (a session number, a session-day); exclusive specs aggregate
    strictly earlier rows. One summary of the users that span chunks and one broadcast join serve all specs; ``across``
    are these users' rows, where the caller can find them with less work than from ``df``.

    When the segments are nested (``[]``, ``[session]``, ``[session, day]``),
    every window orders by the remaining segment columns before ``order``:
    the same row order, but one sort order for all windows, so Spark sorts
    the rows once instead of once per segment.
    """
    segments = sorted({tuple(s[4]) for s in specs})
    sid = {seg: i for i, seg in enumerate(segments)}
    full = max(segments, key=len)
    nested = all(full[:len(seg)] == seg for seg in segments)
    last = F.struct(*[F.col(c) for c in order])
    added = []
    for name, kind, col, excl, seg in specs:
        base = local_window(user, [*full[len(seg):], *order] if nested else order, seg)
        if kind == "next":
            added += [col.alias(f"_li_{name}"), F.lead(col).over(base).alias(f"_le_{name}")]
            continue
        backward = kind == "rsum"
        frame = ((Window.currentRow, Window.unboundedFollowing) if backward
                 else (Window.unboundedPreceding, Window.currentRow))
        added.append(_AGG[kind](col).over(base.rowsBetween(*frame)).alias(f"_li_{name}"))
        if excl:
            frame = (1, Window.unboundedFollowing) if backward else (Window.unboundedPreceding, -1)
            added.append(_AGG[kind](col).over(base.rowsBetween(*frame)).alias(f"_le_{name}"))
    for seg, i in sid.items():
        key = F.struct(*[F.col(c) for c in seg]) if seg else F.struct(F.lit(0).alias("_"))
        added.append(key.alias(f"_seg{i}"))
    across = (rows_of_spanning(df) if across is None else across).select("*", *added)
    df = df.select("*", *added)

    # One exchange by user serves every window below (their keys all start with ``user``).
    summary = across.groupBy(CHUNK, *user).agg(
        F.min(last).alias(START),
        *[F.min_by(f"_seg{i}", last).alias(f"_fseg{i}") for i in sid.values()],
        *[F.max_by(f"_seg{i}", last).alias(f"_tseg{i}") for i in sid.values()],
        # What a chunk hands on: its last row's running value, or its first row's for sums from the end and next rows.
        *[(F.min_by if s[1] in ("rsum", "next") else F.max_by)(f"_li_{s[0]}", last).alias(f"_t_{s[0]}") for s in specs],
    ).repartition(*user)
    # Tails of consecutive chunks that end in the same segment accumulate.
    cum = []
    for name, kind, _, _, seg in specs:
        i = sid[tuple(seg)]
        w_tail = Window.partitionBy(*user, f"_tseg{i}").orderBy(START).rowsBetween(Window.unboundedPreceding, 0)
        if kind == "next":
            cum.append(F.col(f"_t_{name}").alias(f"_c_{name}"))
        elif kind == "rsum":  # heads of consecutive chunks that begin in the same segment
            w_head = (Window.partitionBy(*user, f"_fseg{i}").orderBy(START)
                      .rowsBetween(0, Window.unboundedFollowing))
            cum.append(F.sum(f"_t_{name}").over(w_head).alias(f"_c_{name}"))
        else:
            cum.append(_AGG[kind](f"_t_{name}").over(w_tail).alias(f"_c_{name}"))
    summary = summary.select(CHUNK, *user, START, *[f"_fseg{i}" for i in sid.values()],
                             *[f"_tseg{i}" for i in sid.values()], *cum)
    w_user = Window.partitionBy(*user).orderBy(START)
    carries = []
    for name, kind, _, _, seg in specs:
        i = sid[tuple(seg)]
        if kind == "next":
            carries.append(F.lead(f"_c_{name}").over(w_user).alias(f"_k_{name}"))
            continue
        if kind == "rsum":
            goes_on = F.lead(f"_fseg{i}").over(w_user) == F.col(f"_tseg{i}")
            carries.append(F.when(goes_on, F.lead(f"_c_{name}").over(w_user)).alias(f"_k_{name}"))
            continue
        continues = F.lag(f"_tseg{i}").over(w_user) == F.col(f"_fseg{i}")
        carries.append(F.when(continues, F.lag(f"_c_{name}").over(w_user)).alias(f"_k_{name}"))
    summary = summary.select(CHUNK, *user, *[f"_{x}seg{i}" for x in "ft" for i in sid.values()], *carries)
    df = df.join(F.broadcast(summary), [CHUNK, *user], "left")  # at most two users per chunk

    temp = [f"_{x}seg{i}" for x in ("", "f", "t") for i in sid.values()]
    values = []
    for name, kind, _, excl, seg in specs:
        i = sid[tuple(seg)]
        if kind == "next":
            values.append(F.coalesce(f"_le_{name}", f"_k_{name}").alias(name))
            temp += [f"_li_{name}", f"_le_{name}", f"_k_{name}"]
            continue
        local = F.col(f"_le_{name}" if excl else f"_li_{name}")
        open_end = f"_tseg{i}" if kind == "rsum" else f"_fseg{i}"
        carry = F.when(F.col(f"_seg{i}") == F.col(open_end), F.col(f"_k_{name}"))
        if kind in ("sum", "rsum"):
            value = F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
        elif kind == "max":
            value = F.greatest(local, carry)
        else:
            value = F.least(local, carry)
        values.append(value.alias(name))
        temp += [f"_li_{name}", f"_k_{name}"] + ([f"_le_{name}"] if excl else [])
    keep = [c for c in df.columns if c not in set(temp) and c not in {s[0] for s in specs}]
    return df.select(*keep, *values)
