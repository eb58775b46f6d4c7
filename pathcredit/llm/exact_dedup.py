"""Exact duplicates of whole texts, with heavy digests split off by a Misra-Gries summary.

Every task summarises its digests with at most ``k`` counters; summaries merge
by adding counters and taking the (k+1)-th largest from all (Misra-Gries
summaries stay valid under that merge). A digest with more than rows/(k+1) rows
is sure to survive. The survivors (at most ``k``) are counted exactly, and those
that really are that frequent get their winner and size broadcast, so their
rows are answered on the map side without moving. The remaining digests, none
of which holds more than rows/(k+1) rows, use an ordinary shuffle.

Defined results: null text counts as empty; texts are equal when identical
after deleting ASCII white space; the row with the most code points, then the
smallest id (nulls last) stays; of fully repeated rows exactly one is kept; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathcredit.llm.common import materialize, whole_text

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised_sha256(text: Column) -> Column:
    return F.sha2(F.regexp_replace(text, WHITE_SPACE, "").cast("binary"), 256)


def pruned(counts: dict[str, int], k: int) -> dict[str, int]:
    """A summary of at most ``k`` counters: take the (k+1)-th largest count from all."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {d: c - cut for d, c in counts.items() if c > cut}


def misra_gries(digests: DataFrame, k: int) -> DataFrame:
    """(digest, counter): at most ``k`` rows per task of ``digests``, a valid summary of that task."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            for d, c in zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist()):
                counts[d] = counts.get(d, 0) + c
            counts = pruned(counts, k)
        yield pa.RecordBatch.from_pydict({"digest": pa.array(list(counts), pa.string()),
                                          "counter": pa.array(list(counts.values()), pa.int64())})
    return digests.select("digest").mapInArrow(summarise, "digest string, counter long")


def heavy_digests(digests: DataFrame, k: int) -> list[str]:
    """Digests that may hold more than rows/(k+1) rows: at most ``k``, none that does is missing."""
    merged = misra_gries(digests, k).groupBy("digest").agg(F.sum("counter").alias("counter"))
    top = merged.orderBy(F.desc("counter"), "digest").limit(k + 1).collect()  # k + 1 rows at most
    cut = top[k]["counter"] if len(top) > k else 0
    return [r["digest"] for r in top[:k] if r["counter"] > cut]


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     k: int | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    ``k`` bounds the counters and the broadcast winners; by default 1024, or
    four for each shuffle partition if that is more, so a remaining group is a
    small part of a partition.
    """
    spark = docs.sparkSession
    k = k or max(1024, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = whole_text(text_col)
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), normalised_sha256(text).alias("digest"),
        F.char_length(text).alias("points"), F.monotonically_increasing_id().alias("row")))
    n_rows = rows.count()

    best = F.min_by(F.struct("id", "row"), F.struct(-F.col("points"), F.col("id").isNull(), "id", "row"))
    candidates = heavy_digests(rows, k)
    heavy = (rows.where(F.col("digest").isin(candidates) if candidates else F.lit(False))
             .groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
             .where(F.col("group_size") * (k + 1) > n_rows))
    winners = materialize(heavy)  # at most k rows
    split = rows.join(F.broadcast(winners), "digest", "left")
    answered = split.where(F.col("group_size").isNotNull())

    group = W.partitionBy("digest")
    ranked = group.orderBy(F.desc("points"), F.col("id").isNull(), "id", "row")
    rest = (split.where(F.col("group_size").isNull()).drop("best", "group_size")
            .withColumn("best", F.first(F.struct("id", "row")).over(ranked))
            .withColumn("group_size", F.count("*").over(group)))
    return answered.select(*rest.columns).unionByName(rest).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("digest").alias("text_sha256"))
