"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; per group (language) the leaves, in the order of their ids, are joined
run by run up to a subroot, and the subroots of the groups in turn to one root. The tree is
never held whole. Its nodes are labelled (level, place) and processed in the order of their
labels, children before parents: a node takes its children's digests out of a priority
queue, hashes them and puts the result into the queue under its parent's label. A reversed
sweep then goes down by falling labels: a node takes its proof suffix (the siblings from
its own level up to the root) out of the queue and delivers it, with their siblings in front, to
its children.

In Spark: a tier covers LEVELS levels. Its blocks of 2**LEVELS consecutive nodes are swept
by one task each with a queue of at most that many digests, and hand one digest on to the
next tier; between tiers Spark's shuffle by (group, block) is the external part of the
queue. So a group that holds most rows is only more blocks, and there are
log(rows) / LEVELS tiers. Places in a group are prefix sums over one row per
(range partition, group).

Defined results: a null value is hashed as ``-``, an empty one as ``0:``; null ids come
first in their group and are never tampered with; rows with one id follow the order of
their leaves, and fully repeated rows are leaves of their own with any of their places; the null
group comes first; a table with one row has its leaf as subroot and root and an empty
proof; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathcredit.llm.common import materialize

LEVELS = 13
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    """H: lowercase hex SHA-256 of the concatenated parts."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """H of the values, each as its UTF-8 byte count, a colon and itself, or a dash when null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]).cast("binary"), 256)


# ------------------------------------------------------------------ sweeps of one block

def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    return max(0, n - 1).bit_length()


def sweep_up(digests: Sequence[str], levels: int) -> dict[tuple[int, int], str]:
    """(level, place) -> digest of all nodes over consecutive leaves, ``levels`` levels high.

    The queue delivers children to parents; a parent with one child hashes that one.
    """
    nodes = {}
    queue = [((0, i), 0, d) for i, d in enumerate(digests)]  # ascending labels: a heap as it stands
    while queue:
        label, _, value = heapq.heappop(queue)
        if label[0]:  # an inner node: all its children come out one after the other
            children = [value]
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            value = digest(*children)
        nodes[label] = value
        level, i = label
        if level < levels:
            heapq.heappush(queue, ((level + 1, i >> 1), i & 1, value))
    return nodes


def sweep_down(nodes: dict[tuple[int, int], str], levels: int, suffix: str, shape: str) -> list[tuple[str, str]]:
    """(proof, shape) of every leaf in order: its siblings up to the block's top, then ``suffix``.

    The shape has a letter for each level: the sibling stands left or right of the path, or there is none (``-``).
    """
    queue = [((-levels, 0), suffix, shape)]
    found = {}
    while queue:
        (level, i), proof, turns = heapq.heappop(queue)  # labels negated: highest first
        level, i = -level, -i
        if not level:
            found[i] = (proof, turns)
            continue
        left, right = nodes.get((level - 1, 2 * i)), nodes.get((level - 1, 2 * i + 1))
        if right is None:
            heapq.heappush(queue, ((1 - level, -2 * i), proof, "-" + turns))
        else:
            heapq.heappush(queue, ((1 - level, -2 * i), right + proof, "R" + turns))
            heapq.heappush(queue, ((1 - level, -2 * i - 1), left + proof, "L" + turns))
    return [found[i] for i in range(len(found))]


def fold(leaf: str, proof: str, shape: str) -> str:
    """The root that a leaf and its proof give."""
    at = 0
    for turn in shape:
        if turn == "-":
            leaf = digest(leaf)
            continue
        sibling = proof[at:at + 64]
        at += 64
        leaf = digest(sibling, leaf) if turn == "L" else digest(leaf, sibling)
    return leaf


# ------------------------------------------------------------------ tiers

_GROUP = ["part", "block"]


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (part, place, total, digest) with the block they lie in and the block's height."""
    high = F.least(F.ceil(F.log2(F.col("total").cast("double"))), F.lit(levels)).cast("int")
    return nodes.withColumn("block", F.shiftright("place", levels)).withColumn("high", high)


def _tops(blocks: DataFrame, levels: int) -> DataFrame:
    """One node per block: the next tier's nodes."""
    def top(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        high = table["high"][0].as_py()
        nodes = sweep_up(table["digest"].to_pylist(), high)
        total = (table["total"][0].as_py() + (1 << levels) - 1) >> levels
        return pa.table({"part": table["part"].slice(0, 1), "place": table["block"].slice(0, 1),
                         "total": pa.array([total], pa.int64()), "digest": pa.array([nodes[high, 0]], pa.string())})
    return blocks.groupBy(*_GROUP).applyInArrow(top, "part long, place long, total long, digest string")


def _delivered(blocks: DataFrame, suffixes: DataFrame, schema: str, rows: Callable) -> DataFrame:
    """Sweeps every block down from its suffix (part, place = block, top, subroot, proof, shape)."""
    def deliver(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        high = table["high"][0].as_py()
        top = {c: above[c][0].as_py() for c in ("root", "subroot", "proof", "shape")}
        nodes = sweep_up(table["digest"].to_pylist(), high)
        return rows(table, top, sweep_down(nodes, high, top["proof"], top["shape"]))
    return blocks.groupBy(*_GROUP).cogroup(
        suffixes.withColumnRenamed("place", "block").groupBy(*_GROUP)).applyInArrow(deliver, schema)


_SUFFIX = "part long, place long, root string, subroot string, proof string, shape string"


def _suffix_rows(table: pa.Table, top: dict, found: list[tuple[str, str]]) -> pa.Table:
    n = table.num_rows
    return pa.table({"part": table["part"], "place": table["place"], "root": pa.array([top["root"]] * n, pa.string()),
                     "subroot": pa.array([top["subroot"]] * n, pa.string()),
                     "proof": pa.array([p for p, _ in found], pa.string()),
                     "shape": pa.array([s for _, s in found], pa.string())})


def _climb(leaves: DataFrame, most: int, levels: int) -> list[DataFrame]:
    """The blocks of every tier, from the leaves to the one whose groups have one block; last the tops' table."""
    tiers = [_blocks(leaves, levels)]
    while True:
        tops = materialize(_tops(tiers[-1], levels))
        most = (most + (1 << levels) - 1) >> levels
        if most <= 1:
            return [*tiers, tops]
        tiers.append(_blocks(tops, levels))


def _placed(docs: DataFrame, order: Sequence[Column], group: Column, columns: Sequence[Column]) -> DataFrame:
    """Rows with their group's number ``part`` (null first) and ``place`` in it, and the group's ``total``."""
    rows = docs.select(group.alias("grp"), F.struct(*order).alias("by"), *columns)
    rows = rows.withColumn("by", F.struct(F.col("grp").isNotNull().alias("g"), "grp", "by"))
    ranges = materialize(rows.repartitionByRange("by").withColumn("pid", F.spark_partition_id()))
    sums = ranges.groupBy("pid", "grp").agg(F.count("*").alias("n"))
    by_group = W.partitionBy("grp")
    sums = sums.select("pid", "grp", (F.sum("n").over(by_group.orderBy("pid")) - F.col("n")).alias("before"),
                       F.sum("n").over(by_group).alias("total"))
    numbers = ranges.select("grp").distinct().select("grp", (F.row_number().over(
        W.orderBy(F.asc_nulls_first("grp"))) - 1).cast("long").alias("part"))  # one row per group
    sums = sums.join(numbers, sums["grp"].eqNullSafe(numbers["grp"])).select(
        "pid", sums["grp"].alias("_grp"), "before", "total", "part")
    inside = F.row_number().over(W.partitionBy("pid", "grp").orderBy("by"))
    placed = ranges.withColumn("rank", inside)
    return placed.join(sums, (placed["pid"] == sums["pid"]) & placed["grp"].eqNullSafe(sums["_grp"])).select(
        "part", (F.col("before") + F.col("rank") - 1).cast("long").alias("place"), F.col("total").cast("long"),
        *[c for c in ranges.columns if c not in ("grp", "by", "pid")])


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
             tamper: Callable[[Column], tuple[Column, dict[str, Column]]] | None = None,
             levels: int = LEVELS) -> DataFrame:
    """(id, leaf, subroot, root, proof, shape, candidate) for every row of ``docs``.

    ``proof`` is the siblings' digests from the leaf's level to the root, ``shape`` the side each stands on.
    ``tamper`` gives, for the id column, a condition and columns to replace where it holds:
    ``candidate`` is the leaf of the row so changed, else the leaf itself.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    cols = {f: F.col(f) for f in fields}
    leaf = leaf_digest(list(cols.values()))
    candidate = leaf
    if tamper is not None:
        when, changed = tamper(F.col(id_col))
        candidate = F.when(when, leaf_digest([changed.get(f, c) for f, c in cols.items()])).otherwise(leaf)
    hashed = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf.alias("digest"),
                         candidate.alias("candidate"), F.monotonically_increasing_id().alias("row"))
    leaves = materialize(_placed(hashed, [F.col("id").isNotNull(), F.col("id"), F.col("digest"), F.col("row")],
                                 F.col("grp"), ["id", "digest", "candidate"]))
    most = leaves.agg(F.max("total")).first()[0] or 0
    n_parts = (leaves.agg(F.max("part")).first()[0] or 0) + 1
    *tiers, subroots = _climb(leaves.select("part", "place", "total", "digest", "id", "candidate"), most, levels)

    over = subroots.select(F.lit(0).cast("long").alias("part"), F.col("part").alias("place"),
                           F.lit(n_parts).cast("long").alias("total"), "digest")
    *upper, roots = _climb(over, n_parts, levels)
    none = F.lit("")
    suffixes = roots.select("part", "place", F.col("digest").alias("root"), none.alias("subroot"),
                            none.alias("proof"), none.alias("shape"))
    for blocks in reversed(upper):
        suffixes = _delivered(blocks, suffixes, _SUFFIX, _suffix_rows)
    suffixes = suffixes.select(F.col("place").alias("part"), "root", "proof", "shape").join(
        subroots.select("part", "place", F.col("digest").alias("subroot")), "part")
    for blocks in reversed(tiers[1:]):
        suffixes = materialize(_delivered(blocks, suffixes, _SUFFIX, _suffix_rows))

    def leaf_rows(table: pa.Table, top: dict, found: list[tuple[str, str]]) -> pa.Table:
        rest = _suffix_rows(table, top, found)
        return pa.table({"id": table["id"], "leaf": table["digest"], "subroot": rest["subroot"], "root": rest["root"],
                         "proof": rest["proof"], "shape": rest["shape"], "candidate": table["candidate"]})
    out = _delivered(tiers[0], suffixes, f"id {id_type}, leaf string, subroot string, root string, proof string, "
                     "shape string, candidate string", leaf_rows)
    return out.withColumnRenamed("id", id_col)


def verified(proofs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified): every candidate folded along its proof."""
    @F.pandas_udf("string")
    def folded(leaf, proof, shape):  # noqa: ANN001, ANN202  columns of a batch
        import pandas as pd
        return pd.Series([fold(*x) for x in zip(leaf, proof, shape)])
    out = proofs.withColumn("folded_root", folded("candidate", "proof", "shape"))
    return out.select(id_col, "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def one_more_char(doc_id: Column) -> tuple[Column, dict[str, Column]]:
    """Tampering: where 7 divides the crc32 of the id as text, ``n_chars`` grows by one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False)), {
        "n_chars": F.col("n_chars") + 1}
