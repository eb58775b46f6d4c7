"""SimHash near-duplicates through vantage-point trees over fingerprints.

Fingerprints are computed in one pass over the text and written as a narrow
table; everything after that works on *distinct* fingerprints, so any number of
copies is one point. Two fingerprints within ``max_bits`` bits differ by at most
one bit on at least one of ``max_bits // 2 + 1`` disjoint parts of the
fingerprint (else they would differ by two on each, more than ``max_bits``
together). So there is one vantage-point tree for each part, whose metric is the
Hamming distance on that part and whose search radius is one bit. That keeps the
overlap at a node's boundary small: on whole fingerprints with radius 4 most
points lie within the radius of any median sphere, and no branch is pruned.

The upper levels of each tree (vantage points and medians from a bounded
sample) cut the points into shards. By the triangle bound, a point's ball
reaches only those shards whose shells its distance to the vantage points
overlaps; it is sent to its home shard and, as a query, to the overlapping ones.
Each shard goes on dividing its points with vantage points of its own, and
leaves compare exactly, on all 64 bits. A shard returns what its links join, as
at most one link per point in it, and the links' connected components come from
rounds of star operations in Spark, logarithmic in a component's size.

Defined results: a null text counts as empty; a text without words has
fingerprint zero, linked like any other; a null id takes part in linking and
gets its component's id; a component with only null ids has a null id; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pathcredit.llm.common import all_columns, fresh, input_order, materialize, whole_text

SEED = 42
HASHES_AT_ONCE = 1 << 16
LEAF = 256
#: Points per shard that the upper levels of a tree aim at, and fingerprints sampled to place them.
SHARD_POINTS = 1 << 15
SAMPLE = 20_000
#: A fingerprint that holds more than this part of all rows is answered by a broadcast.
HOT = 1024
_BIT = (np.uint64(1) << np.arange(64, dtype=np.uint64))


# ------------------------------------------------------------------ fingerprints

def simhash64(text: bytes, shingle: int = 4) -> int:
    """The UTF-8 text's fingerprint: bit b is set when more than half of its shingles' XXH64 have it set."""
    words = text.lower().split()  # of bytes: lowers A-Z only, splits at space and \t to \r only
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()  # end of each word's slot in the joined text
    joined = memoryview(b" ".join(words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        spans = zip(starts[:n], (e - 1 for e in ends[shingle - 1:]))
    counts = np.zeros(64, np.int64)
    hashes: list[int] = []
    for a, b in spans:
        hashes.append(digest(joined[a:b], SEED))
        if len(hashes) == HASHES_AT_ONCE:
            counts += _bit_counts(hashes)
            hashes = []
    counts += _bit_counts(hashes)
    return int(np.bitwise_or.reduce(_BIT[2 * counts > n], initial=np.uint64(0)))


def _bit_counts(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """(id, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash64(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])
    return docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text")).mapInArrow(
        hashed, f"id {id_type}, fp long")


# ------------------------------------------------------------------ vantage-point trees

def parts(max_bits: int) -> list[np.uint64]:
    """Masks of the disjoint parts: two fingerprints within ``max_bits`` differ by at most 1 on one of them."""
    n = max_bits // 2 + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(cuts, cuts[1:])]


def distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask).astype(np.int16)


def _vantage(points: np.ndarray, mask: np.uint64, seed: int) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that divide the points, or None when no tried one does."""
    rng = np.random.default_rng(seed)
    best = None
    for v in points[rng.integers(0, len(points), 6)]:
        d = distance(points, v, mask)
        inner = np.bincount(d, minlength=65).cumsum()
        t = int(np.abs(inner - len(points) / 2).argmin())
        small = min(inner[t], len(points) - inner[t])
        if small and (best is None or small > best[0]):
            best = (small, v, t)
    return best and (best[1], best[2])


def upper_tree(sample: np.ndarray, mask: np.uint64, depth: int) -> list[tuple[np.uint64, int]]:
    """Vantage point and radius of the nodes above the shards, as a heap of 2**depth - 1 nodes."""
    nodes, level = [], [sample]
    for at in range(depth):
        below = []
        for i, points in enumerate(level):
            v, t = (_vantage(points, mask, 1000 * at + i) if len(points) > 1 else None) or (np.uint64(0), 32)
            nodes.append((v, t))
            near = distance(points, v, mask) <= t
            below += [points[near], points[~near]]
        level = below
    return nodes


def reach(points: np.ndarray, tree: list[tuple[np.uint64, int]], depth: int, mask: np.uint64,
          radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, shard, home): the shards each point's ball overlaps.

    A pair meets where one of the two is at home, so a point is a query only in
    shards in front of its own home.
    """
    index = np.arange(len(points))
    node, home = np.zeros(len(points), np.int64), np.ones(len(points), bool)
    v_of = np.array([v for v, _ in tree] or [0], np.uint64)
    t_of = np.array([t for _, t in tree] or [0], np.int16)
    for _ in range(depth):
        d = np.bitwise_count((points[index] ^ v_of[node]) & mask).astype(np.int16)
        t = t_of[node]
        inner, outer = d - radius <= t, d + radius > t
        at_inner = d <= t
        index, home, node = (np.concatenate(x) for x in (
            (index[inner], index[outer]), (home[inner] & at_inner[inner], home[outer] & ~at_inner[outer]),
            (2 * node[inner] + 1, 2 * node[outer] + 2)))
    shard = node - (2 ** depth - 1)
    own = np.zeros(len(points), np.int64)
    own[index[home]] = shard[home]
    keep = home | (shard < own[index])
    return index[keep], shard[keep], home[keep]


class Sets:
    """Union-find over array positions."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, of: np.ndarray) -> np.ndarray:
        roots = self.parent[of]
        while not np.array_equal(up := self.parent[roots], roots):
            roots = up
        return roots

    def join(self, members: np.ndarray) -> None:
        roots = np.unique(self.roots(members))
        self.parent[roots] = roots[0]
        self.parent[members] = roots[0]


def links_within(fps: np.ndarray, home: np.ndarray, mask: np.uint64, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the links (<= ``max_bits`` bits) of home points to home points and queries join.

    One link for each linked point but the smallest of its set, to that smallest one.
    """
    sets = Sets(len(fps))
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    every = np.arange(len(fps))
    # (home points, queries, metric, search radius on it); the home points are among the queries.
    todo = [(every[home], every, mask, 1, 0)]
    while todo:
        own, asked, metric, radius, seed = todo.pop()
        if len(own) <= LEAF or len(asked) <= LEAF:
            _compare(fps, own, asked, max_bits, sets)
            continue
        cut = _vantage(fps[own], metric, seed)
        if cut is None and metric != full:  # all equal on this part: go on with whole fingerprints
            todo.append((own, asked, full, max_bits, seed + 1))
            continue
        if cut is None:
            _compare(fps, own, asked, max_bits, sets)
            continue
        v, t = cut
        d_own, d_asked = distance(fps[own], v, metric), distance(fps[asked], v, metric)
        inner, outer = d_asked - radius <= t, d_asked + radius > t
        if metric == full and inner.mean() + outer.mean() > 1.98:  # no branch can be pruned any more
            _compare(fps, own, asked, max_bits, sets)
            continue
        todo.append((own[d_own <= t], asked[inner], metric, radius, seed + 1))
        todo.append((own[d_own > t], asked[outer], metric, radius, seed + 1))
    root = sets.roots(every)
    smallest = np.full(len(fps), np.iinfo(np.int64).max)
    signed = fps.view(np.int64)
    np.minimum.at(smallest, root, signed)
    linked = smallest[root] != signed
    return signed[linked], smallest[root][linked]


def _compare(fps: np.ndarray, own: np.ndarray, asked: np.ndarray, max_bits: int, sets: Sets) -> None:
    """Exact comparison in blocks of bounded size."""
    if not len(own) or not len(asked):
        return
    rows = max(1, (1 << 20) // len(own))
    for at in range(0, len(asked), rows):
        block = asked[at:at + rows]
        bits = np.bitwise_count(fps[block][:, None] ^ fps[own][None, :])
        near = bits - np.uint8(1) < max_bits  # 0 bits, the point itself, wraps around to 255
        for i in np.flatnonzero(near.any(axis=1)):
            sets.join(np.append(own[near[i]], block[i]))


def near_links(points: DataFrame, max_bits: int, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(a, b): links between distinct fingerprints ``points(fp)`` that connect all pairs within ``max_bits``."""
    n = points.count()
    depth = max(0, math.ceil(math.log2(max(1, n / shard_points))))
    masks = parts(max_bits)
    # Only the upper vantage points come from a sample of at most about SAMPLE fingerprints, never of more than
    # about half; every point is searched.
    some = points.where(F.pmod(F.xxhash64("fp"), F.lit(max(2, math.ceil(n / SAMPLE)))) == 0) if depth else points.limit(0)
    sample = np.array([r[0] for r in some.orderBy("fp").collect()], np.int64).view(np.uint64)
    trees = [upper_tree(sample, m, depth) for m in masks]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column(0)).view(np.uint64)
            for k, (mask, tree) in enumerate(zip(masks, trees)):
                index, shard, home = reach(fp, tree, depth, mask, 1)
                yield pa.RecordBatch.from_pydict({
                    "tree": np.full(len(index), k, np.int32), "shard": shard.astype(np.int32),
                    "fp": fp[index].view(np.int64), "home": home})

    def search(key: tuple, table: pa.Table) -> pa.Table:
        mask = masks[key[0].as_py()]
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = links_within(fps, table.column("home").to_numpy(), mask, max_bits)
        return pa.table({"a": a, "b": b})

    routed = points.mapInArrow(route, "tree int, shard int, fp long, home boolean")
    return routed.groupBy("tree", "shard").applyInArrow(search, "a long, b long")


# ------------------------------------------------------------------ connected components

def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node's smallest reachable node, from links (a, b); nodes of any ordered type.

    Rounds of star operations: every node's larger neighbours are linked to its smallest
    neighbour (large star), then its smaller ones and itself (small star), until only stars
    remain, whose centres are the components' smallest nodes. Components stay connected in
    both steps and long chains shrink by a constant factor, whatever the order of their nodes.
    Minima are aggregated before their shuffle, and Spark may split the joins' skewed side. A round's links
    are written under the shared checkpoint folder.
    """
    a, b = F.col("a"), F.col("b")
    now, after = _stars(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    before = None
    while after != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = materialize(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = after
        now, after = _stars(small.unionByName(least.select("u", F.col("m").alias("v"))))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct links, written, and their count and checksum, observed on the way."""
    seen = Observation()
    state = [F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")]
    written = materialize(links.distinct().observe(seen, *state))
    return written, tuple(sorted(seen.get.items()))


def simhash_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                            max_bits: int = 4, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``."""
    rows = materialize(fingerprints(docs, id_col, text_col, shingle))
    points = materialize(rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")))
    # Nodes are ordered by their smallest id, nulls last, so a component's root already has its smallest id.
    node = F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id"), "fp")
    named = points.select("fp", node.alias("node"))
    links = near_links(points.select("fp"), max_bits, shard_points)
    for end in ("a", "b"):
        links = links.join(named.select(F.col("fp").alias(end), F.col("node").alias(f"node_{end}")), end)
    linked = components(links.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    roots = linked.select(F.col("node.fp").alias("fp"), F.col("root.id").alias("component_id"), F.lit(True).alias("linked"))
    answer = points.join(roots, "fp", "left").select(
        "fp", "n", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"))
    # Fingerprints of more than rows / HOT rows, fewer than HOT of them, are answered where the rows lie.
    answer = materialize(answer)
    least = F.floor(answer.select(F.sum("n")).scalar() / HOT)
    hot = answer.where(F.col("n") > least).select("fp", F.struct("component_id").alias("hot"))
    split = rows.join(F.broadcast(hot), "fp", "left")
    there = split.where(F.col("hot").isNotNull()).select("id", "fp", "hot.component_id")
    rest = split.where(F.col("hot").isNull()).join(answer.where(F.col("n") <= least), "fp").select("id", "fp", "component_id")
    return there.unionByName(rest).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id stays.

    Rows are told apart by where they lie, so repeated and null ids are no exception (nulls come last).
    """
    stored = docs if input_order(docs) else materialize(docs)
    row = fresh("row")
    keyed = stored.select(*all_columns(docs), F.struct(*input_order(stored)).alias(row))
    ranked = keyed.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                                   F.col(row).alias("row")).alias("id"), F.col(text_col).alias("text"))
    found = simhash_near_duplicates(ranked, "id", "text", shingle, max_bits)
    extra = materialize(found.where("id <> component_id").select(F.col("id.row").alias(row)))
    return keyed.join(extra, row, "left_anti").select(*all_columns(docs))
