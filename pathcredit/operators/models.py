"""Step 3: credit models, assisted conversions and transitions, without chain arrays.

The reference stores every session prefix as an array (a chain per visit) and
unnests them: Σ n(n+1)/2 touches per session. Every model here is instead an
aggregate over visits, using running sums within a session-day and totals per
(session, day):

* a chain is a visit *i*; its date, conversions and revenue are visit *i*'s;
* touch *j* belongs to every chain *i ≥ j* of its session, so what a touch
  earns is a suffix sum: the rest of its own day (summed from the day's end, never
  a difference, so credit of nothing is exactly 0) plus, for each later day, that
  day's total times the running weight of the session's earlier days.

Output grain of every model: (goal_id, start_date, source_code) with visits,
conversions and revenue as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.config import materialize
from pathcredit.constants import DEFAULT_HALF_LIFE_DAYS
from pathcredit.functions.codes import is_significant
from pathcredit.operators.scan import CHUNK, ORDER, USER, layout, running

SESSION = [*USER, "session_id"]
S = ["session_id"]
SD = ["session_id", "chain_date"]
RESULT = ["goal_id", "attribution_type", "start_date", "source_code", "visits", "conversions", "revenue"]


def _midnight(date_col: str | Column) -> Column:
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.unix_seconds(d.cast("timestamp"))


def _decay_weight(half_life: float) -> Column:
    """Decay weight of a visit relative to midnight of its own day: bounded by
    2^(1 day/H) however long the session runs."""
    H = float(half_life) * 86400.0
    return F.pow(F.lit(2.0), (F.col("ts") - _midnight("chain_date")) / F.lit(H))


def touch_table(sessions: DataFrame, checkpoint: bool = True, half_life: float = DEFAULT_HALF_LIFE_DAYS,
                n_buckets: int | None = None, across: DataFrame | None = None) -> DataFrame:
    """Sessionized visits (all their columns) plus the running quantities the models share.

    The decay weights' running sum is included for ``half_life``; the value is
    recorded in the column metadata so ``time_decay`` knows when it can reuse it.
    Keeping every session column lets the job write this one table instead of
    the sessions and the touches separately. ``across`` are the sessions' rows of visitors in several chunks, where
    the caller can find them with less work.
    """
    def with_values(df: DataFrame) -> DataFrame:
        df = df.select("*", F.to_date("utc_start_time").alias("chain_date"), F.col("conversions").cast("double").alias("c"),
                       F.col("revenue").cast("double").alias("r"))
        return df.withColumn("k", (F.col("c") > 0).cast("long")).withColumn("z", _decay_weight(half_life))

    touch = F.struct(*ORDER, "source_code")
    specs = [
        ("gidx", "sum", F.lit(1).cast("long"), False, []),
        ("uprev", "max", touch, True, []),
        ("first", "min", touch, False, S),
        ("ls", "max", F.when(is_significant("source_code"), touch), False, S),
        ("prev", "max", touch, True, S),
        ("ssuf_n", "rsum", F.lit(1).cast("long"), False, S),
        ("ssuf_c", "rsum", F.col("c"), False, S),
        ("suf_n", "rsum", F.lit(1).cast("long"), False, SD),
        ("suf_c", "rsum", F.col("c"), False, SD),
        ("suf_k", "rsum", F.col("k"), False, SD),
        ("rest_r", "rsum", F.col("r"), True, SD),
        ("suf_a1", "rsum", 1.0 / F.col("pos"), False, SD),
        ("suf_ac", "rsum", F.col("c") / F.col("pos"), False, SD),
        ("suf_ar", "rsum", F.col("r") / F.col("pos"), False, SD),
        ("cum_z", "sum", F.col("z"), False, SD),
    ]
    df = running(with_values(sessions), specs, across=None if across is None else with_values(across))
    df = df.select(*[c for c in df.columns if c not in ("first", "ls", "prev", "uprev")],
                   F.col("first.source_code").alias("first_source"),
                   F.col("ls.source_code").alias("last_sig_source"),
                   F.col("prev.source_code").alias("prev_source"),
                   F.col("uprev.source_code").alias("user_prev_source"))
    meta = {"half_life": float(half_life)}
    df = df.withColumn("z", F.col("z").alias("z", metadata=meta)) \
        .withColumn("cum_z", F.col("cum_z").alias("cum_z", metadata=meta))
    return materialize(df, layout(), n_buckets) if checkpoint else df


def session_day_totals(t: DataFrame) -> DataFrame:
    """One row per (session, day): chains, conversions, revenue, converting chains,
    linear shares and decay weight sums (for the touch table's half-life)."""
    return t.groupBy(*SESSION, "chain_date").agg(
        F.count("*").cast("double").alias("tot_n"), F.sum("c").alias("tot_c"), F.sum("r").alias("tot_r"),
        F.sum("k").alias("tot_k"),
        F.sum(1.0 / F.col("pos")).alias("tot_a1"), F.sum(F.col("c") / F.col("pos")).alias("tot_ac"),
        F.sum(F.col("r") / F.col("pos")).alias("tot_ar"), F.sum("z").alias("tot_z"),
    )


def _result(df: DataFrame, model: str, source: str, n: Column, c: Column, r: Column,
            date: str = "chain_date") -> DataFrame:
    return df.groupBy("goal_id", F.col(date).alias("start_date"), F.col(source).alias("source_code")).agg(
        F.sum(n).cast("double").alias("visits"), F.sum(c).cast("double").alias("conversions"),
        F.sum(r).cast("double").alias("revenue"),
    ).select(F.col("goal_id"), F.lit(model).alias("attribution_type"), "start_date", "source_code",
             "visits", "conversions", "revenue")


def _on_session_days(groups: DataFrame, days: DataFrame, dims: list[str], sums: list[str]) -> DataFrame:
    """``groups`` per (session, dims, day), with a row of zeros for every later day of the session.

    A session of D days with S groups gives at most S·D rows; no day is paired
    with another. All rows of a (session, dims) meet in one shuffle.
    """
    keys = [*SESSION, *dims]
    starts = groups.groupBy(*keys).agg(F.min("chain_date").alias("_from"))
    later = (starts.join(days.select(*SESSION, "chain_date"), SESSION).where(F.col("chain_date") > F.col("_from"))
             .select(*keys, "chain_date", *[F.lit(0.0).alias(c) for c in sums]))
    both = groups.select(*keys, "chain_date", *[F.col(c).cast("double").alias(c) for c in sums]).unionByName(later)
    return both.repartition(*keys).groupBy(*keys, "chain_date").agg(*[F.sum(c).alias(c) for c in sums])


#: Half-lives in a block of running weights: 2**256 and its square stay far inside the range of doubles.
_BLOCK = 256.0


def _earlier(df: DataFrame, keys: list[str], weight: str, half_lives: Column | None = None) -> DataFrame:
    """Adds ``_acc``: the sum of ``weight`` over the earlier days of the same ``keys``, each halved once
    per half-life up to this day. ``half_lives`` (one per day; None: no decay) may be null for rows
    that do not decay.

    Time is cut into blocks of 256 half-lives, in which weights are taken relative to the block's
    start, so no power overflows: a day adds the running sum of its own block and the
    whole block before it; what lies further back is below 2**-256. One sort serves both windows.
    """
    if half_lives is None:
        before = Window.partitionBy(*keys).orderBy("chain_date").rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("_acc", F.coalesce(F.sum(weight).over(before), F.lit(0.0)))
    x = F.coalesce(F.unix_date("chain_date") * half_lives, F.lit(0.0))
    df = df.withColumn("_b", F.floor(x / _BLOCK)).withColumn("_s", x - F.col("_b") * _BLOCK)
    moved = F.sum(F.col(weight) * F.pow(F.lit(2.0), "_s"))
    own = moved.over(Window.partitionBy(*keys, "_b").orderBy("chain_date").rowsBetween(Window.unboundedPreceding, -1))
    last = moved.over(Window.partitionBy(*keys).orderBy("_b").rangeBetween(-1, -1))
    acc = F.coalesce(own, F.lit(0.0)) + F.coalesce(last, F.lit(0.0)) * F.lit(2.0 ** -_BLOCK)
    return df.withColumn("_acc", acc * F.pow(F.lit(2.0), -F.col("_s"))).drop("_b", "_s")


def last_touch(t: DataFrame) -> DataFrame:
    """Full credit to the chain's endpoint: the visit itself."""
    return _result(t, "last_touch", "source_code", F.lit(1), F.col("c"), F.col("r"))


def first_touch(t: DataFrame) -> DataFrame:
    """Full credit to the session's first touch (carried on every touch of the session)."""
    return _result(t, "first_touch", "first_source", F.lit(1), F.col("c"), F.col("r"))


def last_significant(t: DataFrame) -> DataFrame:
    """Full credit to the latest significant touch of the chain, else to the endpoint."""
    chosen = t.withColumn("_src", F.coalesce(F.col("last_sig_source"), F.col("source_code")))
    return _result(chosen, "last_significant", "_src", F.lit(1), F.col("c"), F.col("r"))


def _linear_groups(t: DataFrame) -> DataFrame:
    """Per (session, day, source): touches ``m`` and what they earn on their own day, ``e*``
    (shares of the day's chains that end at or after the touch)."""
    return t.groupBy(*SESSION, "chain_date", "source_code").agg(*_linear_sums())


def _linear_sums() -> list[Column]:
    return [F.count("*").cast("double").alias("m"), F.sum("suf_a1").alias("e1"), F.sum("suf_ac").alias("ec"),
            F.sum("suf_ar").alias("er")]


def linear(t: DataFrame, st: DataFrame | None = None) -> DataFrame:
    """Each touch earns value / chain length from every chain that contains it."""
    st = session_day_totals(t) if st is None else st
    x = _on_session_days(_linear_groups(t), st, ["source_code"], ["m", "e1", "ec", "er"])
    x = _earlier(x, [*SESSION, "source_code"], "m").join(
        st.select(*SESSION, "chain_date", "tot_a1", "tot_ac", "tot_ar"), [*SESSION, "chain_date"])

    def credit(tot: str, own_day: str) -> Column:
        return F.col("_acc") * F.col(tot) + F.col(own_day)

    return _result(x, "linear", "source_code", credit("tot_a1", "e1"), credit("tot_ac", "ec"), credit("tot_ar", "er"))


def _per_day(half_life: float) -> Column:
    return F.lit(1.0 / float(half_life))


def _own_weights(t: DataFrame, half_life: float) -> bool:
    """Whether the touches' weights are those of ``half_life``."""
    if half_life <= 0:
        raise ValueError(f"half_life must be positive, got {half_life}")
    return "cum_z" in t.columns and t.schema["cum_z"].metadata.get("half_life") == float(half_life)


def _valued(t: DataFrame, half_life: float, st: DataFrame | None = None) -> DataFrame:
    """The touches with their chains' values over the chains' weight sums, ``q*``.

    With weights relative to midnight of the endpoint's day D, chain *i* has
    ``E_i = P(D) + running z`` where ``P(D)`` carries the earlier days of the
    session, and touch *j* earns ``z_j · 2^((mid(d_j)-mid(D))/H) · v_i / E_i``.
    """
    reuse = _own_weights(t, half_life)
    if not reuse:
        t = t.drop("z", "cum_z").withColumn("z", _decay_weight(half_life))
        t = running(t, [("cum_z", "sum", F.col("z"), False, SD)])
    if reuse and st is not None and "tot_z" in st.columns:
        z_days = st.select(*SESSION, "chain_date", "tot_z")
    else:
        z_days = t.groupBy(*SESSION, "chain_date").agg(F.sum("z").alias("tot_z"))

    prior = _earlier(z_days, list(SESSION), "tot_z", _per_day(half_life)).select(
        *SESSION, "chain_date", F.col("_acc").alias("_prior")).where("_prior > 0")
    keyed = t.select(CHUNK, *SESSION, "chain_date").distinct().join(prior, [*SESSION, "chain_date"])
    q = t.join(keyed, [CHUNK, *SESSION, "chain_date"], "left")
    E = F.coalesce(F.col("_prior"), F.lit(0.0)) + F.col("cum_z")
    return q.withColumn("q1", 1.0 / E).withColumn("qc", F.col("c") / E).withColumn("qr", F.col("r") / E)


def _rests(q: DataFrame) -> DataFrame:
    """The touches of :func:`_valued` with the rest of the day's ``suf_q*``."""
    return running(q, [(f"suf_{m}", "rsum", F.col(m), False, SD) for m in ("q1", "qc", "qr")])


def _decay_earned() -> list[Column]:
    """What weights earn on their own day, ``mzq_*``."""
    return [F.sum(F.col("z") * F.col(f"suf_{m}")).alias(f"mzq_{m}") for m in ("q1", "qc", "qr")]


def _decay_sums() -> list[Column]:
    """Per (session, day, source): weight sums ``mz``, what they earn on their own day, and chain values ``s*``."""
    return [F.sum("z").alias("mz"), *_decay_earned(), *[F.sum(m).alias(f"s{m}") for m in ("q1", "qc", "qr")]]


def _chain_values(groups: DataFrame, prefix: str = "s") -> DataFrame:
    """Per (session, day): the normalised values of its chains."""
    return groups.groupBy(*SESSION, "chain_date").agg(*[F.sum(f"{prefix}{m}").alias(f"tot_{m}") for m in ("q1", "qc", "qr")])


def time_decay(t: DataFrame, half_life: float = DEFAULT_HALF_LIFE_DAYS,
               st: DataFrame | None = None) -> DataFrame:
    """Weights ``2^(-Δdays/half_life)`` to the chain's endpoint, normalised per chain."""
    groups = _rests(_valued(t, half_life, st)).groupBy(*SESSION, "chain_date", "source_code").agg(*_decay_sums())
    qt = _chain_values(groups)
    x = _on_session_days(groups, qt, ["source_code"], ["mz", "mzq_q1", "mzq_qc", "mzq_qr"])
    x = _earlier(x, [*SESSION, "source_code"], "mz", _per_day(half_life)).join(qt, [*SESSION, "chain_date"])

    def credit(m: str) -> Column:
        return F.col("_acc") * F.col(f"tot_{m}") + F.col(f"mzq_{m}")

    return _result(x, "time_decay", "source_code", credit("q1"), credit("qc"), credit("qr"))


def _first_occurrences(t: DataFrame) -> DataFrame:
    """Per (session, source): the day of the source's first touch (weight 1) and what that day's later
    chains hold: conversions, revenue, converting chains."""
    first = t.groupBy(*SESSION, "source_code").agg(F.min_by(F.struct(
        "chain_date", (F.col("suf_c") - F.col("c")).alias("ac"), F.coalesce("rest_r", F.lit(0.0)).alias("ar"),
        (F.col("suf_k") - F.col("k")).alias("ak")), F.col("pos")).alias("f"))
    return first.select(*SESSION, "source_code", "f.*", F.lit(1.0).alias("w"))


def assisted(t: DataFrame, st: DataFrame | None = None) -> DataFrame:
    """Per (goal, day, source): conversions and revenue of converting chains in which
    the source appears before the last position (once per chain)."""
    st = session_day_totals(t) if st is None else st
    x = _on_session_days(_first_occurrences(t), st, ["source_code"], ["w", "ac", "ar", "ak"])
    x = _earlier(x, [*SESSION, "source_code"], "w").join(
        st.select(*SESSION, "chain_date", "tot_c", "tot_r", "tot_k"), [*SESSION, "chain_date"])

    def after(tot: str, own_day: str) -> Column:
        return F.col("_acc") * F.col(tot) + F.col(own_day)

    return (x.groupBy("goal_id", F.col("chain_date").alias("start_date"), "source_code")
            .agg(F.sum(after("tot_c", "ac")).alias("assisted_conversions"),
                 F.sum(after("tot_r", "ar")).alias("assisted_revenue"), F.sum(after("tot_k", "ak")).alias("_chains"))
            .where(F.col("_chains") > 0).drop("_chains"))


def last_touch_with_assists(t: DataFrame, st: DataFrame | None = None) -> DataFrame:
    """Last-touch rows with assisted totals for the same (goal, day, source), missing → 0.

    Assists on a (day, source) without a last-touch row are not kept, as in the
    reference's left join.
    """
    a = assisted(t, st)
    return (last_touch(t).join(a, ["goal_id", "start_date", "source_code"], "left")
            .fillna(0.0, ["assisted_conversions", "assisted_revenue"]))


def transitions(t: DataFrame, st: DataFrame | None = None) -> DataFrame:
    """Consecutive (prev, next) source pairs over all chains: occurrences and Σ chain conversions."""
    st = session_day_totals(t) if st is None else st
    dims = ["prev_source", "source_code"]
    pairs = t.where(F.col("pos") >= 2).groupBy(*SESSION, "chain_date", *dims).agg(
        F.count("*").alias("m"), F.sum("suf_n").alias("en"), F.sum("suf_c").alias("ec"))
    x = _earlier(_on_session_days(pairs, st, dims, ["m", "en", "ec"]), [*SESSION, *dims], "m").join(
        st.select(*SESSION, "chain_date", "tot_n", "tot_c"), [*SESSION, "chain_date"])
    return x.groupBy("goal_id", F.col("chain_date").alias("start_date"),
                     F.col("prev_source").alias("prev_source_code"),
                     F.col("source_code").alias("next_source_code")).agg(
        F.sum(F.col("_acc") * F.col("tot_n") + F.col("en")).alias("transitions"),
        F.sum(F.col("_acc") * F.col("tot_c") + F.col("ec")).alias("converting_chains"))


#: What a touch earns from a chain on a later day of its session, by model: its weight times the day's totals.
_LATER = {"linear": ("tot_a1", "tot_ac", "tot_ar"), "time_decay": ("tot_q1", "tot_qc", "tot_qr"),
          "last_touch": ("tot_c", "tot_r", "tot_k")}
_TOTALS = [c for cols in _LATER.values() for c in cols]


def _session_days(totals: DataFrame) -> DataFrame:
    """One row per session: its days in order, and their totals. A session has no more days than the calendar."""
    day = F.struct("chain_date", *[F.col(c).cast("double").alias(c) for c in _TOTALS])
    return (totals.groupBy(*SESSION).agg(F.sort_array(F.collect_list(day)).alias("_totals"))
            .withColumn("_dates", F.col("_totals.chain_date")))


def _source_days(t: DataFrame) -> DataFrame:
    """Per (session, source, day): touches ``m``, weight sums ``mz`` and what the day's chains after the first of these
    touches hold (conversions, revenue, converting chains). Added up in their chunks first; a (session, source) meets in one shuffle."""
    keys = [*SESSION, "source_code", "chain_date"]
    rest = F.struct((F.col("suf_c") - F.col("c")).alias("c"), F.coalesce("rest_r", F.lit(0.0)).alias("r"),
                    (F.col("suf_k") - F.col("k")).cast("double").alias("k"))
    in_chunk = t.groupBy(CHUNK, *keys).agg(F.count("*").alias("m"), F.sum("z").alias("mz"), F.min("pos").alias("_at"),
                                           F.min_by(rest, "pos").alias("_rest"))
    return in_chunk.repartition(*SESSION, "source_code").groupBy(*keys).agg(
        F.sum("m").cast("double").alias("m"), F.sum("mz").alias("mz"), F.min_by("_rest", "_at").alias("_rest"))


def _on_later_days(groups: DataFrame, days: DataFrame, half_life: float) -> DataFrame:
    """Per (goal, day, source): what the ``groups`` of :func:`_source_days` earn from chains on later days of their sessions,
    in the columns of the days' totals; assists with those of the first day.

    A source's weights stay the same, but for decay, from a day it occurs on to the next one. So a row per (session, source,
    day) moves to the session's ``days``, and the days it answers for are added up where they are made: no row of a later
    day is shuffled. At most S·D are made of a session with D days and S sources.
    """
    keys = [*SESSION, "source_code"]
    by_day = Window.partitionBy(*keys).orderBy("chain_date")
    x = _earlier(groups, keys, "mz", _per_day(half_life)).select(
        *keys, F.col("chain_date").alias("_from"), F.lead("chain_date").over(by_day).alias("_to"),
        F.sum("m").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_m"),
        (F.col("_acc") + F.col("mz")).alias("_mz"),
        F.when(F.lag("chain_date").over(by_day).isNull(), F.col("_rest")).alias("_rest"))
    x = x.join(days, SESSION)
    at = F.array_position("_dates", F.col("_from")).cast("int")
    to = F.when(F.col("_to").isNull(), F.size("_dates")).otherwise(F.array_position("_dates", F.col("_to")).cast("int"))
    zero = F.lit(0.0)
    own = F.array(F.struct(F.col("_from").alias("chain_date"), *[
        F.coalesce(F.col(f"_rest.{c[-1]}"), zero).alias(c) if c in _LATER["last_touch"] else zero.alias(c) for c in _TOTALS]))
    answered = F.slice("_totals", at + 1, to - at)
    x = x.select("goal_id", "source_code", "_from", "_m", "_mz",
                 F.inline(F.when(F.col("_rest").isNull(), answered).otherwise(F.concat(own, answered))))
    left = F.pow(F.lit(2.0), F.datediff("_from", "chain_date") * _per_day(half_life))
    weight = {"linear": F.col("_m"), "time_decay": F.col("_mz") * left, "last_touch": F.lit(1.0)}
    return x.groupBy("goal_id", "chain_date", "source_code").agg(*[
        F.sum(weight[model] * F.col(c)).alias(c) for model, cols in _LATER.items() for c in cols])


def attribution_all(t: DataFrame, half_life: float = DEFAULT_HALF_LIFE_DAYS,
                    calculated_at: Column | None = None, st: DataFrame | None = None) -> DataFrame:
    """All five models in one result table (assisted totals only on last-touch rows).

    Same numbers as the five model functions and :func:`last_touch_with_assists`,
    with fewer passes and rows: what touches earn on their own day is added up per (goal, day, source) as it
    is read; one table of (session, source, day) rows, for linear, time decay and assisted alike, meets the sessions'
    days, which are written once; and every output row — endpoint models straight from
    the touch table, day rows, assists tagged as last touch — meets in one
    final aggregation. Assists on a (day, source) without a last-touch row are
    dropped there, as in the reference's left join.
    """
    st = session_day_totals(t) if st is None else st
    known = t.where(" AND ".join(f"{c} IS NOT NULL" for c in (*SESSION, "chain_date")))
    valued = _valued(known, half_life, st)
    days = materialize(_session_days(st.join(_chain_values(valued, ""), [*SESSION, "chain_date"])))
    weighted = known if _own_weights(t, half_life) else known.withColumn("z", _decay_weight(half_life))
    later = _on_later_days(_source_days(weighted), days, half_life)
    zero = F.lit(0.0)
    earned = _rests(valued).groupBy("goal_id", "chain_date", "source_code").agg(*_linear_sums(), *_decay_earned())
    earned = earned.select("goal_id", "chain_date", "source_code", *[
        F.col(c).alias(a) for c, a in zip(("e1", "ec", "er", "mzq_q1", "mzq_qc", "mzq_qr"), _TOTALS)],
        *[zero.alias(c) for c in _LATER["last_touch"]])
    by_day = earned.unionByName(later).groupBy("goal_id", "chain_date", "source_code").agg(*[F.sum(c).alias(c) for c in _TOTALS])
    values = ("_n", "_c", "_r", "_ac", "_ar")
    rows = F.array(*[F.struct(F.lit(model).alias("_model"), *[F.coalesce(F.col(c), zero).alias(v) for c, v in zip(cols, values)],
                              *[zero.alias(v) for v in values[len(cols):]], F.lit(1).alias("_keep"))
                     for model, cols in list(_LATER.items())[:2]],
                   F.struct(F.lit("last_touch").alias("_model"), *[zero.alias(v) for v in values[:3]],
                            *[F.coalesce(F.col(c), zero).alias(v) for c, v in zip(_LATER["last_touch"], values[3:])], F.lit(0).alias("_keep")))
    day_rows = by_day.select("goal_id", F.col("chain_date").alias("_date"), F.col("source_code").alias("_src"), F.inline(rows))

    picks = F.array(*[F.struct(F.lit(model).alias("_model"), src.alias("_src")) for model, src in (
        ("first_touch", F.col("first_source")),
        ("last_touch", F.col("source_code")),
        ("last_significant", F.coalesce(F.col("last_sig_source"), F.col("source_code"))),
    )])
    endpoint_rows = t.select("goal_id", F.col("chain_date").alias("_date"), F.lit(1.0).alias("_n"),
                             F.col("c").alias("_c"), F.col("r").alias("_r"), zero.alias("_ac"), zero.alias("_ar"),
                             F.lit(1).alias("_keep"), F.inline(picks))

    out = (endpoint_rows.unionByName(day_rows)
           .groupBy("goal_id", F.col("_model").alias("attribution_type"), F.col("_date").alias("start_date"),
                    F.col("_src").alias("source_code"))
           .agg(F.sum("_n").alias("visits"), F.sum("_c").alias("conversions"), F.sum("_r").alias("revenue"),
                F.sum("_ac").alias("assisted_conversions"), F.sum("_ar").alias("assisted_revenue"),
                F.max("_keep").alias("_keep"))
           .where(F.col("_keep") == 1).drop("_keep"))
    stamp = calculated_at if calculated_at is not None else F.current_timestamp()
    return out.select(*RESULT, "assisted_conversions", "assisted_revenue").withColumn("calculated_at", stamp)
