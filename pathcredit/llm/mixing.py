"""Interleaving of sources at target weights, by Pfair release times and deadlines.

Each source's rows are cut into blocks of ``block_rows`` consecutive rows. With
target weight w, block j of a source may not start before slot floor(j / w) and
must be done by slot ceil((j + 1) / w); giving every slot to the released block
with the earliest deadline meets all of them, so after any number of slots each
source is less than one block away from its share.

Weights are whole shares of a period of P slots, in which a source with share a
places exactly a blocks, so the schedule repeats every P slots. Only one period
(P slots, a parameter) is scheduled, as a fold inside one SQL expression; block
j of a source then stands in slot (j div a) * P + slot_in_period(j mod a), by a
broadcast join with the P-row period. Row ranks inside a source come from range
partitions and prefix sums over (partition, source) totals, so a source that
holds a third of all rows is spread like any other.

All rows are kept: when a source runs dry its slots stay empty and the others go
on in their order (``on_target`` tells the rows before that). Sources without a
target, null ones included, form the stream ``OTHER``; a stream of weight 0
follows after all others.

Targets without any rows leave their share to the others.

Defined results: null ids sort first within their source; ties and repeated rows
get a position each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathcredit.llm.common import all_columns, fresh, input_order, materialize

OTHER = "(other)"
BLOCK_ROWS = 16

#: Production target: the hot source is held to 22 of 100 slots, unnamed sources share 2.
TARGETS = {"src0": 22, **{f"src{i}": 4 for i in range(1, 20)}, OTHER: 2}


def period_schedule(targets: dict[str, int]) -> Column:
    """array<struct<slot, stream, turn, release, deadline>> of one period, as one folding expression.

    ``turn`` is the block's number in the period. Ties go to the stream named first.
    """
    active = [(name, a) for name, a in targets.items() if a > 0]
    period = sum(a for _, a in active)
    names = F.array(*[F.lit(n) for n, _ in active])
    shares = F.array(*[F.lit(a).cast("long") for _, a in active])
    length = F.lit(period).cast("long")

    def window(name: Column, share: Column, turn: Column, rank: Column) -> Column:
        release = F.floor(turn * length / share).cast("long")
        deadline = F.ceil((turn + 1) * length / share).cast("long")
        return F.struct(deadline.alias("deadline"), rank.alias("rank"), name.alias("stream"),
                        turn.alias("turn"), release.alias("release"))

    def step(state: Column, slot: Column) -> Column:
        waiting = F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(len(active) - 1)), lambda i: window(
                names[i], shares[i], state["turns"][i], i)),
            lambda x: (x["release"] <= slot))
        chosen = F.array_min(waiting)  # the earliest deadline, then the stream named first
        return F.struct(
            F.transform(state["turns"], lambda turn, i: turn + F.when(i == chosen["rank"], 1).otherwise(0)).alias("turns"),
            F.concat(state["slots"], F.array(F.struct(
                slot.alias("slot"), chosen["stream"].alias("stream"), chosen["turn"].alias("turn"),
                chosen["release"].alias("release"), chosen["deadline"].alias("deadline")))).alias("slots"))

    empty = F.from_json(F.lit("[]"), "array<struct<slot: bigint, stream: string, turn: bigint, release: bigint, "
                                     "deadline: bigint>>")
    start = F.struct(F.transform(shares, lambda _: F.lit(0).cast("long")).alias("turns"), empty.alias("slots"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), length - 1), start, step, lambda s: s["slots"])


def period_table(spark, targets: dict[str, int]) -> DataFrame:
    """(slot, stream, turn, release, deadline, placed): the period, one row per slot.

    ``placed`` has, in the order of the active streams, the blocks placed in the slots before.
    """
    active = [n for n, a in targets.items() if a > 0]
    slots = spark.range(1).select(F.explode(period_schedule(targets)).alias("s")).select("s.*")
    before = W.orderBy("slot").rowsBetween(W.unboundedPreceding, -1)  # P rows
    counts = [F.coalesce(F.sum((F.col("stream") == n).cast("long")).over(before), F.lit(0)) for n in active]
    return slots.withColumn("placed", F.array(*counts))


def mix_sources(docs: DataFrame, targets: dict[str, int] | None = None, id_col: str = "doc_id",
                source_col: str = "source", block_rows: int = BLOCK_ROWS, row_key: Column | None = None) -> DataFrame:
    """(id, source, stream, block, release, deadline, slot, position, on_target) for every row of ``docs``.

    ``position`` numbers all rows from 0 in mixed order. With ``row_key`` a last
    column of that name carries it, to join a row's other columns back.
    """
    targets = dict(targets or TARGETS)
    targets.setdefault(OTHER, 0)
    if any(a < 0 or a != int(a) for a in targets.values()) or not any(targets.values()):
        raise ValueError("targets are whole shares, at least one of them positive")
    spark = docs.sparkSession
    stream = F.when(F.col("source").isin([n for n in targets if n != OTHER]), F.col("source")).otherwise(F.lit(OTHER))
    key = (row_key if row_key is not None else F.monotonically_increasing_id()).alias("row_key")
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = materialize(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), key)
                         .withColumn("stream", stream))
    # Written, so that totals and rows see the same sampled range bounds.
    ranges = materialize(narrow.repartitionByRange(n_ranges, "stream", "id", "row_key")
                         .withColumn("pid", F.spark_partition_id()))

    totals = ranges.groupBy("stream", "pid").agg(F.count("*").alias("n"))
    before = W.partitionBy("stream").orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("stream", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    ranked = (ranges.withColumn("rn", F.row_number().over(W.partitionBy("stream", "pid").orderBy("id", "row_key")))
              .join(F.broadcast(offsets), ["stream", "pid"])  # at most one row per (stream, partition)
              .withColumn("rank", F.col("rows_before") + F.col("rn") - 1)
              .withColumn("block", F.floor(F.col("rank") / block_rows)))

    rows_of = dict(totals.groupBy("stream").agg(F.sum("n")).collect())  # one row per stream of the targets
    # Streams without rows leave their share to the others; with none left any stream will do.
    active = [n for n, a in targets.items() if a > 0 and rows_of.get(n)] or [n for n, a in targets.items() if a > 0][:1]
    period = sum(targets[n] for n in active)
    sizes = F.array(*[F.lit(int(rows_of.get(n, 0))).cast("long") for n in active])
    shares = F.array(*[F.lit(targets[n]).cast("long") for n in active])
    share = F.element_at(F.create_map(*[x for n in targets for x in (F.lit(n), F.lit(targets[n]).cast("long"))]), F.col("stream"))
    in_block = F.col("rank") - F.col("block") * block_rows
    table = period_table(spark, {n: targets[n] for n in active}).withColumnRenamed("stream", "of")
    scheduled = (ranked.withColumn("share", share)
                 .withColumn("round", F.floor(F.col("block") / F.greatest(F.col("share"), F.lit(1))))
                 .withColumn("turn", F.col("block") - F.col("round") * F.greatest(F.col("share"), F.lit(1)))
                 .join(F.broadcast(table.withColumnRenamed("turn", "nth")),  # P rows
                       (F.col("stream") == F.col("of")) & (F.col("turn") == F.col("nth")) & (F.col("share") > 0), "left"))
    # Rows placed before a slot: for each stream its whole periods and this period's blocks so far.
    filled = F.aggregate(
        F.sequence(F.lit(0), F.lit(len(active) - 1)), F.lit(0).cast("long"),
        lambda acc, i: acc + F.least(sizes[i], (F.col("round") * shares[i] + F.col("placed")[i]) * block_rows))
    # A stream is dry from the slot on that would take its first missing block.
    dry_round = [rows_of.get(n, 0) // block_rows // targets[n] for n in active]
    idle = F.col("share") == 0
    weighted = sum(rows_of.get(n, 0) for n in active)
    # Streams of weight 0 (only OTHER may be unnamed) follow one after another.
    after, at = F.lit(weighted).cast("long"), weighted
    for n in [n for n, a in targets.items() if a == 0]:
        after = F.when(F.col("stream") == n, F.lit(at).cast("long")).otherwise(after)
        at += rows_of.get(n, 0)
    out = scheduled.select(
        F.col("id").alias(id_col), "source", "stream", "block",
        F.when(~idle, F.col("round") * period + F.col("release")).alias("release"),
        F.when(~idle, F.col("round") * period + F.col("deadline")).alias("deadline"),
        F.when(~idle, F.col("round") * period + F.col("slot")).alias("slot"),
        F.when(idle, after + F.col("rank")).otherwise(filled + in_block).cast("long").alias("position"),
        (~idle & (F.col("round") < min(dry_round))).alias("on_target"), F.col("row_key"))
    return out if row_key is not None else out.drop("row_key")


def in_mixed_order(docs: DataFrame, targets: dict[str, int] | None = None, id_col: str = "doc_id",
                   source_col: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of ``docs``, lying in mixed order across and inside the partitions (and files)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The file a row lies in and its number there name it for good; other inputs are written once for that.
    stored = docs if input_order(docs) else materialize(docs)
    row, position = fresh("row"), fresh("position")
    keyed = stored.select(*all_columns(docs), F.struct(*input_order(stored)).alias(row))
    mixed = mix_sources(keyed, targets, id_col, source_col, block_rows, F.col(row))
    placed = mixed.select(F.col("row_key").alias(row), F.col("position").alias(position))
    return keyed.join(placed, row).repartitionByRange(n, position).sortWithinPartitions(position).select(*all_columns(docs))
