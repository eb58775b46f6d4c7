"""Conversation repair by run-length dynamic programming.

A conversation is legal when its role initials match ``(s?(ua)+)?``. Rows may be kept, given
the role user or assistant, or deleted, and empty turns inserted; the cheapest such
edit is found, of equally cheap ones that whose letters (Delete, Insert, Keep, Rerole) come
first in ASCII.

What a row can do depends only on its symbol: role initial and fault. Equal
consecutive symbols are collapsed into runs. The costs to go at a run's beginning are the costs at its end
under a power of the symbol's min-plus transition over the four states of the
grammar, taken from cached binary powers. The audit is then unrolled from the start: in
every state the least letter that still reaches the cheapest cost.

In Spark: conversations are dealt by their id, sorted, and streamed through tasks one at a
time. Conversations with over ``heavy_rows`` rows or ``heavy_bytes`` bytes of text are cut into
ranges instead: faults are found range by range (repetitions across ranges by one row per
range and distinct text), only the symbols, one byte a row and no more than the audit
itself, meet in one place, and the repaired texts stream through the hash in order, a
batch at a time.

Defined results: a null role, text, id or turn counts as one space where it is read as text; null
turns come first and are not counted among the turns; rows of one turn go by role, then text; roles
other than system, user and assistant by their initial, and those with another initial cannot be
kept; a null id is a conversation of its own; a conversation without rows has
zeros, an empty audit and the hash of nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathcredit.llm.common import materialize

HEAVY_ROWS = 1 << 16
HEAVY_BYTES = 64 << 20
RANGE_ROWS = 1 << 14
SPACE = " \t\n\x0b\x0c\r"
INF = math.inf

# States: nothing yet, after s, after u, after a.
ENDS = (0, 3)
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = (2, 2, 3, 2)  # where an inserted or re-roled row leads: the one role that may follow
ROLE = ("user", "user", "assistant", "user")
DELETE, OTHER = 3, 2  # costs; a truncated row that stays costs one more
MUST_GO = "D"  # symbol of blank and repeated rows; others are s, u, a, x, upper case when truncated


# ------------------------------------------------------------------ min-plus transitions

Costs = tuple[float, ...]


def with_inserts(costs: Costs) -> Costs:
    """Cheapest costs to go when rows may be inserted first."""
    c0, c1, c2, c3 = costs
    c2, c3 = min(c2, OTHER + c3), min(c3, OTHER + c2)
    return min(c0, OTHER + c2), min(c1, OTHER + c2), c2, c3


AT_END = with_inserts(tuple(0 if q in ENDS else INF for q in range(4)))


def choices(symbol: str, q: int) -> Iterator[tuple[str, float, int]]:
    """(letter, cost, next state) of a row in state ``q``, in the letters' order."""
    yield "D", DELETE, q
    if symbol == MUST_GO:
        return
    late = symbol.isupper()
    if symbol.lower() in KEPT[q]:
        yield "K", late, KEPT[q][symbol.lower()]
    yield "R", OTHER + late, TURN[q]


@lru_cache(maxsize=None)
def before_row(symbol: str, after: Costs) -> Costs:
    """Costs to go before a row, from those after it."""
    return with_inserts(tuple(min(cost + after[to] for _, cost, to in choices(symbol, q)) for q in range(4)))


@lru_cache(maxsize=None)
def power(symbol: str, j: int) -> tuple[Costs, ...]:
    """Min-plus matrix of 2**j rows of one symbol: cost from each state to each."""
    if j:
        m = power(symbol, j - 1)
        return tuple(tuple(min(m[a][k] + m[k][b] for k in range(4)) for b in range(4)) for a in range(4))
    columns = [before_row(symbol, tuple(0 if q == b else INF for q in range(4))) for b in range(4)]
    return tuple(tuple(columns[b][a] for b in range(4)) for a in range(4))


def before_run(symbol: str, n: int, after: Costs) -> Costs:
    """Costs to go before ``n`` rows of one symbol, by the binary powers of its transition."""
    j = 0
    while n:
        if n & 1:
            m = power(symbol, j)
            after = tuple(min(m[a][b] + after[b] for b in range(4)) for a in range(4))
        n, j = n >> 1, j + 1
    return after


def _inside(symbol: str, n: int, after: Costs) -> list[Costs]:
    """Costs to go, less their least, after each of a run's rows, in order."""
    found = []
    for _ in range(n):
        low = min(after)
        after = tuple(c - low for c in after)
        found.append(after)
        after = before_row(symbol, after)
    return found[::-1]


@lru_cache(maxsize=1 << 16)
def letters(symbol: str, q: int, after: Costs) -> tuple[str, int]:
    """The least cheapest letters up to and with a row's own, and the state after the row."""
    before = before_row(symbol, after)
    for letter, cost, to in choices(symbol, q):
        if letter > "I" and OTHER + before[TURN[q]] == before[q]:
            break
        if cost + after[to] == before[q]:
            return letter, to
    rest, to = letters(symbol, TURN[q], after)
    return "I" + rest, to


def solve(symbols: str) -> tuple[int, list[str]]:
    """Cheapest cost, and for every row the audit letters up to and with its own; last those after all rows."""
    runs = [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]
    ends = [AT_END]
    for s, n in reversed(runs):
        ends.append(before_run(s, n, ends[-1]))
    total = int(ends.pop()[0])
    audit, q = [], 0
    for (s, n), after in zip(runs, reversed(ends)):
        for costs in _inside(s, n, after):
            letter, q = letters(s, q, costs)
            audit.append(letter)
    tail = ""
    while q not in ENDS:
        tail, q = tail + "I", TURN[q]
    return total, [*audit, tail]


def repaired_roles(audit: list[str], initials: str) -> Iterator[tuple[list[str], str | None, bool]]:
    """For every row: roles inserted before it, the row's new role (None: its own), and whether it stays; last the rest."""
    q = 0
    for step, initial in zip(audit, [*initials, None]):
        inserted = []
        for _ in range(step.count("I")):
            inserted.append(ROLE[q])
            q = TURN[q]
        last = step[-1:] if initial is not None else ""
        if last == "R":
            yield inserted, ROLE[q], True
            q = TURN[q]
        elif last == "K":
            yield inserted, None, True
            q = KEPT[q][initial]
        else:
            yield inserted, None, False


# ------------------------------------------------------------------ rows

def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text, kept): rows damaged by the crc32 of ``conv:turn`` modulo 20; dropped ones have ``kept`` false."""
    def words(c: str):  # noqa: ANN202
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(words(conv), F.lit(":"), words(turn)).cast("binary")) % 20).alias("kind")
    df = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), words(role).alias("role"),
                     words(text).alias("text"), kind)
    text_after = (F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                  .otherwise(F.col("text")))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                     text_after.alias("text"), (F.col("kind") != 0).alias("kept"), copies.alias("copy")).drop("copy")


def undamaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """The same columns for rows as they are."""
    return rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *[
        F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
        F.lit(True).alias("kept"))


def row_symbol(role: str, text: str, repeated: bool) -> tuple[str, int]:
    """(symbol, fault): fault 1 blank, 2 repeated, 3 truncated, else 0."""
    words = text.rstrip(SPACE)
    if not words:
        return MUST_GO, 1
    if repeated:
        return MUST_GO, 2
    symbol = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return (symbol, 0) if words[-1] in ".!?" else (symbol.upper(), 3)


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(turns: list, roles: list[str], texts: list[str]) -> tuple:
    """The result's columns of one conversation's rows in order."""
    seen, symbols, faults = set(), [], [0, 0, 0, 0]
    for role, text in zip(roles, texts):
        symbol, fault = row_symbol(role, text, (role, text) in seen)
        seen.add((role, text))
        symbols.append(symbol)
        faults[fault] += 1
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    initials = [r[:1] for r in roles]
    cost, audit = solve("".join(symbols))
    lines = []
    for (inserted, role, stays), old, text in zip(repaired_roles(audit, initials), [*roles, ""], [*texts, ""]):
        lines += [f"{r}:" for r in inserted]
        if stays:
            lines.append(f"{role or old}:{text}")
    return (gaps, faults[1], faults[2], faults[3], illegal_pairs(initials), cost, "".join(audit),
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _streamed(sorted_rows: DataFrame, id_type: str) -> DataFrame:
    """Repairs conversations whose rows follow one another in a task, one conversation in memory at a time."""
    names = [f.split()[0] for f in _RESULT.split(", ")]
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, found, ids = None, [], [], []

        def close() -> None:
            ids.append(current[0])
            found.append(repair(*([r[i] for r in rows] for i in range(3))))

        for batch in batches:
            for conv, turn, role, text, kept in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if current != (conv,):
                    if current is not None:
                        close()
                    current, rows = (conv,), []
                if kept:
                    rows.append((turn, role, text))
            if found:
                yield _batch(ids, found, batch.schema.field(0).type, schema)
                ids, found = [], []
        if current is not None:
            close()
            yield _batch(ids, found, batch.schema.field(0).type, schema)
    return sorted_rows.mapInArrow(run, f"conv {id_type}, {_RESULT}")


def _batch(ids: list, found: list[tuple], id_type: pa.DataType, schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*found), schema)]
    return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], ["conv", *schema.names])


ORDER = ("turn", "role", "text")


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", heavy_rows: int = HEAVY_ROWS,
                         heavy_bytes: int = HEAVY_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    ``rows`` are those of :func:`damaged` or :func:`undamaged`.
    """
    id_type = rows.schema["conv"].dataType.simpleString()
    key = F.coalesce(F.concat(F.lit(":"), F.col("conv").cast("string")), F.lit(""))  # nulls are a conversation too
    sizes = rows.groupBy(key.alias("key")).agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    heavy = materialize(sizes.where((F.col("rows") > heavy_rows) | (F.col("bytes") > heavy_bytes)).select("key", "rows"))
    total = heavy.agg(F.sum("rows")).first()[0]
    usual = rows
    if total:
        keyed = rows.withColumn("key", key)
        usual = keyed.join(heavy, "key", "left_anti").drop("key")
    out = _streamed(usual.repartition("conv").sortWithinPartitions("conv", *ORDER), id_type)
    if total:
        ranges = max(1, math.ceil(total / range_rows))
        out = out.unionByName(_repair_heavy(keyed.join(heavy.select("key"), "key"), ranges, id_type))
    return out.withColumnRenamed("conv", conv_col)


# ------------------------------------------------------------------ conversations cut into ranges

def _repair_heavy(rows: DataFrame, n_ranges: int, id_type: str) -> DataFrame:
    convs = rows.groupBy("key").agg(F.first("conv").alias("conv"))
    kept = materialize(rows.where("kept").select("key", *ORDER)).withColumn("row", F.monotonically_increasing_id())
    cut = materialize(kept.repartitionByRange(n_ranges, "key", *ORDER, "row").withColumn("pid", F.spark_partition_id()))
    here = W.partitionBy("pid", "key")
    cut = cut.withColumn("rn", F.row_number().over(here.orderBy(*ORDER, "row")))
    cut = cut.withColumn("digest", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    cut = cut.withColumn("nth", F.row_number().over(W.partitionBy("pid", "key", "digest").orderBy("rn")))
    # Of a text's first rows in each range, at most one a range, only that of the first range is new.
    firsts = cut.where("nth = 1").withColumn("repeated", F.col("pid") > F.min("pid").over(W.partitionBy("key", "digest")))
    marked = materialize(firsts.unionByName(cut.where("nth > 1").withColumn("repeated", F.lit(True)))
                         .drop("digest", "nth"))

    def symbols(table: pa.Table) -> pa.Table:
        table = table.sort_by("rn")
        roles, texts, turns = (table[c].to_pylist() for c in ("role", "text", "turn"))
        found = [row_symbol(r, t, x) for r, t, x in zip(roles, texts, table["repeated"].to_pylist())]
        faults = [f for _, f in found]
        initials = [r[:1] for r in roles]
        known = [t for t in turns if t is not None]
        return pa.table({
            "key": table["key"].slice(0, 1), "pid": table["pid"].slice(0, 1),
            "symbols": ["".join(s for s, _ in found)], "initials": ["".join(i or "-" for i in initials)],
            **{n: pa.array([faults.count(k)], pa.int64()) for k, n in ((1, "blank"), (2, "duplicate"), (3, "truncated"))},
            "illegal": pa.array([illegal_pairs(initials)], pa.int64()),
            "low": pa.array([min(known, default=None)], pa.int64()), "high": pa.array([max(known, default=None)], pa.int64()),
            "turns": pa.array([len(set(known))], pa.int64())})
    pieces = materialize(marked.groupBy("pid", "key").applyInArrow(
        symbols, "key string, pid int, symbols string, initials string, blank long, duplicate long, truncated long, "
        "illegal long, low long, high long, turns long"))

    def audits(table: pa.Table) -> pa.Table:
        table = table.sort_by("pid")
        parts = table["symbols"].to_pylist()
        cost, audit = solve("".join(parts))
        initials = "".join(table["initials"].to_pylist())
        steps = [f"{','.join(inserted)}|{'' if not stays else role or '='}" for inserted, role, stays in
                 repaired_roles(audit, initials)]
        edges = [0]
        for p in parts:
            edges.append(edges[-1] + len(p))
        low, high = (table[c].to_pylist() for c in ("low", "high"))
        shared = sum(a is not None and a == b for a, b in zip(high, low[1:]))
        firsts = [initials[e] for e in edges[1:-1]]
        lasts = [initials[e - 1] for e in edges[1:-1]]
        known = [t for t in low + high if t is not None]
        turns = sum(table["turns"].to_pylist()) - shared
        first = [True] + [False] * (len(parts) - 1)
        sums = {c: sum(table[c].to_pylist()) for c in ("blank", "duplicate", "truncated", "illegal")}
        sums["illegal"] += sum(a + b not in ("su", "ua", "au") for a, b in zip(lasts, firsts))
        sums |= {"gaps": max(known) - min(known) + 1 - turns if known else 0, "cost": cost}
        return pa.table({
            "key": table["key"], "pid": table["pid"],
            "steps": [steps[a:b] for a, b in zip(edges, edges[1:])],
            "tail": [""] * (len(parts) - 1) + [steps[-1]],
            "audit": ["".join(audit)] + [None] * (len(parts) - 1),
            **{c: pa.array([v if f else None for f in first], pa.int64()) for c, v in sums.items()}})
    solved = materialize(pieces.groupBy("key").applyInArrow(
        audits, "key string, pid int, steps array<string>, tail string, audit string, blank long, duplicate long, "
        "truncated long, illegal long, gaps long, cost long"))

    steps = solved.select("key", "pid", F.posexplode("steps").alias("at", "step"))
    edits = marked.select("key", "pid", (F.col("rn") - 1).alias("at"), "role", "text").join(steps, ["key", "pid", "at"])
    rest = solved.where("tail <> ''").select("key", "pid", F.lit(1 << 30).alias("at"), F.lit("").alias("role"), F.lit("").alias("text"),
                                             F.col("tail").alias("step"))
    ordered = edits.unionByName(rest).repartition("key").sortWithinPartitions("key", "pid", "at")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, hashed, empty, found = None, hashlib.sha256(), True, []
        for batch in batches:
            for k, role, text, step in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                             for c in ("key", "role", "text", "step"))):
                if k != current:
                    if current is not None:
                        found.append((current, hashed.hexdigest()))
                    current, hashed, empty = k, hashlib.sha256(), True
                inserted, mine = step.split("|")
                lines = [f"{r}:" for r in inserted.split(",") if r]
                if mine:
                    lines.append(f"{role if mine == '=' else mine}:{text}")
                for line in lines:
                    hashed.update(line.encode() if empty else b"\n" + line.encode())
                    empty = False
        if current is not None:
            found.append((current, hashed.hexdigest()))
        yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in found], pa.string()),
                                          "repaired_sha256": pa.array([h for _, h in found], pa.string())})
    hashed = ordered.mapInArrow(hashes, "key string, repaired_sha256 string")
    summary = solved.where("audit is not null").drop("pid", "steps", "tail")
    out = convs.join(summary, "key", "left").join(hashed, "key", "left")
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = hashlib.sha256(b"").hexdigest()
    out = out.fillna(zeros).fillna({"audit": "", "repaired_sha256": nothing})
    return out.select("conv", *[f.split()[0] for f in _RESULT.split(", ")])
