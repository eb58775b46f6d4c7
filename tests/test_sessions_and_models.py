import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import fixtures as FX
from conftest import SF
from pathcredit.operators import chains as C
from pathcredit.operators import lookback as L
from pathcredit.operators import models as M
from pathcredit.operators.prepare import live_visits, per_goal, prepare_visits
from pathcredit.operators.scan import VISITOR, chunk_rows, running, spanning
from pathcredit.operators.sessions import quantile_row, session_timeout, sessionize, timeout_row
from pathcredit.sources.visits import raw_visits


def _touches(spark, visits, timeout=FX.SESSION_GAP, n_chunks=None):
    p = prepare_visits(FX.raw(spark, visits), FX.COUNTER, FX.GOAL)
    return M.touch_table(sessionize(p, timeout=timeout, n_chunks=n_chunks))


EVERYONE = [v for visits in FX.HISTORIES.values() for v in visits]
MODELS = {"first_touch": M.first_touch, "last_touch": M.last_touch, "last_significant": M.last_significant,
          "linear": M.linear, "time_decay": M.time_decay}


def _by_day(df, *values):
    return {(r.start_date, r.source_code): tuple(round(r[v], 8) for v in values) for r in df.collect()}


def test_timeout_matches_golden(spark):
    p = prepare_visits(raw_visits(spark, SF), 1, 99)
    assert session_timeout(p).first().timeout_seconds == 116956


def test_timeout_falls_back_without_gaps(spark):
    p = prepare_visits(FX.raw(spark, FX.HISTORIES["lone buyer"]), FX.COUNTER, FX.GOAL)
    assert session_timeout(p).first().timeout_seconds == 1800


@pytest.mark.parametrize("n_chunks", [1, 3, 16])
def test_sessions_do_not_depend_on_chunking(spark, n_chunks):
    p = prepare_visits(raw_visits(spark, SF), 1, 99)
    s = sessionize(p, n_chunks=n_chunks)
    T = 116956
    w = Window.partitionBy("user_id").orderBy("ts", "visit_id")
    b = p.withColumn("ts", F.unix_seconds("utc_start_time")).withColumn("pt", F.lag("ts").over(w))
    b = b.withColumn("st", (F.col("pt").isNull() | (F.col("ts") - F.col("pt") > T)).cast("long"))
    b = b.withColumn("sid", F.sum("st").over(w))
    b = b.withColumn("ps", F.row_number().over(Window.partitionBy("user_id", "sid").orderBy("ts", "visit_id")))
    got = s.select("visit_id", "session_id", "pos")
    exp = b.select("visit_id", F.col("sid").alias("session_id"), F.col("ps").cast("long").alias("pos"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


@pytest.mark.parametrize("n_chunks", [1, 16])
def test_models_match_plain_reckoning(spark, n_chunks):
    t = _touches(spark, EVERYONE, n_chunks=n_chunks)
    chains = FX.session_chains(EVERYONE)
    for name, model in MODELS.items():
        assert _by_day(model(t), "visits", "conversions", "revenue") == FX.credit(chains, name), name
    assert _by_day(M.assisted(t), "assisted_conversions", "assisted_revenue") == FX.assists(chains)
    got = {(r.start_date, r.prev_source_code, r.next_source_code): (r.transitions, r.converting_chains)
           for r in M.transitions(t).collect()}
    assert got == FX.steps(chains)


@pytest.mark.parametrize("history", ["buys twice, then looks", "same second"])
def test_each_history_conserves_visits_and_conversions(spark, history):
    visits = FX.HISTORIES[history]
    out = M.attribution_all(_touches(spark, visits)).groupBy("attribution_type").agg(
        F.sum("visits").alias("v"), F.sum("conversions").alias("c"), F.sum("revenue").alias("r")).collect()
    chains = FX.session_chains(visits)
    assert {r.attribution_type for r in out} == set(MODELS)
    for r in out:
        assert (r.v, r.c, r.r) == pytest.approx((len(chains), sum(x[-1]["c"] for x in chains), sum(x[-1]["r"] for x in chains)))


@pytest.mark.parametrize("n_chunks", [1, 4, 16])
def test_channels_after_the_last_conversion_earn_exactly_nothing(spark, n_chunks):
    """Unrounded: sixty visits of a day, two channels seen only after the last conversion."""
    visits = [FX.visit(41, i / 5, "3_6" if i % 2 else "2_7", 0.1 * i if i % 3 == 0 else None) for i in range(50)]
    visits += [FX.visit(41, 10 + i / 7, "7" if i % 2 else "8_4") for i in range(10)]
    t = _touches(spark, visits, n_chunks=n_chunks)
    late = M.attribution_all(t).where(F.col("source_code").isin("7", "8_4") & (F.col("conversions") != 0))
    assert late.count() == 0
    both = M.linear(t).unionByName(M.time_decay(t)).where(F.col("source_code").isin("7", "8_4"))
    rows = both.select("conversions", "revenue", F.try_divide("revenue", "conversions").alias("ratio"), "visits").collect()
    assert len(rows) == 4 and all(tuple(r)[:3] == (0.0, 0.0, None) and r.visits > 0 for r in rows)


def test_decay_needs_a_half_life(spark):
    with pytest.raises(ValueError):
        M.time_decay(_touches(spark, FX.HISTORIES["lone buyer"]), half_life=0)


def test_lookback_models_match_plain_reckoning(spark):
    touches = _touches(spark, EVERYONE)
    for days in (0, 1, 90):
        ends = L.chain_ends(touches, days)
        ch = C.lookback_chains(touches, ends)
        chains = FX.lookback_chains(EVERYONE, days)
        for name, got in (("first_touch", L.lookback_first_touch(touches, ends)),
                          ("last_significant", L.lookback_last_significant(ends)),
                          ("linear", L.lookback_linear(touches, ends, days)),
                          ("time_decay", L.lookback_time_decay(touches, ends, days))):
            want = {}
            for chain in chains:
                for code, x in FX.shares(chain, name).items():
                    want[code] = want.get(code, 0.0) + x
            assert {r.source_code: r.credit for r in got.collect()} == pytest.approx(want), (name, days)
        seen = Counter(code for chain in chains for code in {v["code"] for v in chain[:-1]})
        assert {r.source_code: r.credit for r in L.lookback_assisted(touches, days).collect()} == seen, days
        assert ch.where("is_converting = 1").count() == len(chains)
        pairs = ch.where("position >= 2").groupBy("user_prev_source", "source_code").count().collect()
        assert {tuple(r)[1:] for r in L.lookback_transitions(touches, days).collect()} == {tuple(r) for r in pairs}


def _crowded(n=160, seed=4):
    """A visitor with many visits in the same second, sources that come again, and conversions among them."""
    rng = random.Random(seed)
    at, visits = 0.0, []
    for i in range(n):
        at += rng.choice([0, 0, 0.5, 3, 30, 200, 900])
        visits.append(FX.visit(81 + (i % 4 == 3), at, rng.choice(["2_7", "3_6", "8_4", "0", "7", "9_2"]),
                               2.0 if rng.random() < 0.3 else None))
    return visits


@pytest.mark.parametrize("days,half_life", [(90, 7.0), (90, 0.01), (90, 1000.0), (3, 0.01), (10, 0.3), (0, 7.0)])
def test_lookback_decay_has_no_pairs_and_matches_plain_reckoning(spark, days, half_life):
    visits = _crowded()
    touches = _touches(spark, visits, n_chunks=5)
    got = L.lookback_time_decay(touches, L.chain_ends(touches, days), days, half_life)
    want = Counter()
    for chain in FX.lookback_chains(visits, days):
        for code in {v["code"] for v in chain}:
            want[code] += 0.0
        for code, x in FX.shares(chain, "time_decay", half_life).items():
            want[code] += x
    assert {r.source_code: r.credit for r in got.collect()} == pytest.approx(dict(want), rel=1e-9, abs=1e-100)


@pytest.mark.parametrize("days", [0, 1, 30, 90, 2000])
def test_lookback_assisted_counts_each_source_once(spark, days):
    visits = _crowded(seed=days)
    want = Counter(code for chain in FX.lookback_chains(visits, days) for code in {v["code"] for v in chain[:-1]})
    for n_chunks in (1, 7):
        got = L.lookback_assisted(_touches(spark, visits, n_chunks=n_chunks), days)
        assert {r.source_code: r.credit for r in got.collect()} == want


def test_lookback_plans_join_no_ranges(spark):
    """A row per visit, conversion and probe is all that is shuffled: joins are only with one row per (chunk, visitor)."""
    touches = _touches(spark, FX.HISTORIES["buys twice, then looks"])
    ends = L.chain_ends(touches, 90)
    for df in (L.lookback_time_decay(touches, ends, 90), L.lookback_assisted(touches, 90)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "explode" not in plan
        assert not any(" Join " in line and (">=" in line or "<=" in line) for line in plan.splitlines())


@pytest.mark.parametrize("days", [0, 20, 400])
def test_lookback_chains_are_intervals_of_indices(spark, days, monkeypatch):
    monkeypatch.setattr(C, "INDEX_BLOCK", 4)
    visits = _crowded(120, seed=11)
    touches = _touches(spark, visits, n_chunks=5)
    ch = C.lookback_chains(touches, L.chain_ends(touches, days))
    got = Counter((r.visit_id, r.position, r.chain_length, r.is_converting, round(r.days_before_conv, 9)) for r in ch.collect())
    want = Counter()
    for vs in FX.live(visits).values():
        for v in (v for v in vs if v["c"]):
            chain = [x for x in vs if x["at"] <= v["at"] and (v["at"] - x["at"]).total_seconds() <= days * 86400]
            want.update((x["id"], i, len(chain), int(x is v), round((v["at"] - x["at"]).total_seconds() / 86400, 9))
                        for i, x in enumerate(chain, 1))
    assert got == want
    plan = ch._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Join Inner", 1)[0] and plan.count("Generate explode(sequence") == 1


def test_only_visitors_across_chunks_are_summarised(spark):
    rows = [(u, i, 1) for u in range(60) for i in range(200 if u == 30 else 5)]
    df = chunk_rows(spark.createDataFrame(rows, "user long, i long, v long"), 10, ["user"], ["i"])
    chunks = {u: set() for u in range(60)}
    for r in df.select("user", "_chunk").distinct().collect():
        chunks[r.user].add(r["_chunk"])
    across = {u for u, c in chunks.items() if len(c) > 1}
    assert 30 in across and {r.user for r in spanning(df).collect()} == across and len(across) < 10


def test_goals_as_rows_inside_chunks_keep_carries(spark):
    """Visits ranged by visitor with several goals each: running values carry over chunk ends for every goal."""
    visits = _crowded(90, seed=2)
    raw = FX.raw(spark, visits)
    many = M.touch_table(per_goal(sessionize(live_visits(raw, FX.COUNTER, (FX.GOAL, 5, 900)), FX.SESSION_GAP, 7, user=VISITOR)))
    one = _touches(spark, visits, n_chunks=1)
    cols = ["visit_id", "session_id", "pos", "gidx", "ssuf_n", "suf_c", "first_source", "prev_source", "user_prev_source"]
    assert many.select("_chunk").distinct().count() > 3
    for goal in (FX.GOAL, 5, 900):
        of_goal = many.where(F.col("goal_id") == goal).withColumn("suf_c", F.col("suf_c") * F.lit(int(goal == FX.GOAL)))
        expected = one.withColumn("suf_c", F.col("suf_c") * F.lit(int(goal == FX.GOAL)))
        assert of_goal.select(*cols).exceptAll(expected.select(*cols)).count() == 0 and of_goal.count() == one.count()


def test_next_values_cross_chunks(spark):
    rows = [(u, i, u * 100 + i) for u in range(3) for i in range(40 if u else 300)]
    df = spark.createDataFrame(rows, "user long, i long, v long")
    got = running(chunk_rows(df, 9, ["user"], ["i"]), [("nxt", "next", F.struct("v"), False, []),
                                                       ("upto", "sum", F.lit(1), False, [])], ["user"], ["i"])
    last = {u: max(i for x, i, _ in rows if x == u) for u in range(3)}
    for r in got.collect():
        assert r.upto == r.i + 1 and (r.nxt and r.nxt.v) == (None if r.i == last[r.user] else r.v + 1)


def test_chains_hold_the_five_arrays(spark):
    chains = C.chain_paths(C.build_chains(_touches(spark, EVERYONE, n_chunks=7)))
    got = sorted((r.path, r.visit_ids, r.times, r.event_types, r.touch_conversions, r.chain_length) for r in chains.collect())

    def joined(values):
        return " > ".join(map(str, values))
    want = sorted((joined(v["code"] for v in c), joined(v["id"] for v in c),
                   joined(int(v["at"].replace(tzinfo=dt.timezone.utc).timestamp()) for v in c), joined("2_VISIT" for _ in c),
                   joined(v["c"] for v in c), len(c)) for c in FX.session_chains(EVERYONE))
    assert got == want


def test_several_goals_move_each_visit_once(spark):
    """Goals become rows inside the chunks: the ordered scan lays out as many visit rows for three goals as for one."""
    raw = raw_visits(spark, SF)
    live = live_visits(raw, 1, (99, 42, 7))
    assert live.count() == prepare_visits(raw, 1, 99).count()
    cut = sessionize(live, timeout=116956, user=VISITOR)
    plan = per_goal(cut)._jdf.queryExecution().executedPlan().toString()
    after_layout = [line for line in plan.splitlines() if "Exchange" in line and "_chunk" in line]
    assert not after_layout
    each = per_goal(cut)
    for goal in (99, 42):
        one = sessionize(prepare_visits(raw, 1, goal), timeout=116956)
        cols = ["visit_id", "session_id", "pos", "conversions", "revenue", "gap"]
        mine = each.where(F.col("goal_id") == goal).select(*cols)
        assert mine.exceptAll(one.select(*cols)).count() == 0 and mine.count() == one.count()


def test_decay_over_many_half_lives(spark):
    """A half-life far shorter than the session: powers of two neither overflow nor vanish too early."""
    visits = [FX.visit(71, 24.0 * i, ("2_7", "3_6", "8_4")[i % 3], 3.0 if i % 4 == 0 else None) for i in range(60)]
    got = _by_day(M.time_decay(_touches(spark, visits), half_life=0.01), "visits", "conversions", "revenue")
    want = {}
    for chain in FX.session_chains(visits):
        end = chain[-1]  # a day is 100 half-lives: the endpoint takes all
        row = want.setdefault((end["at"].date(), end["code"]), [0.0, 0.0, 0.0])
        for k, x in enumerate((1, end["c"], end["r"])):
            row[k] += x
    assert {k: v for k, v in got.items() if any(v)} == {k: pytest.approx(tuple(v)) for k, v in want.items()}


def test_one_visit_id_converting_on_two_dates_is_two_chains(spark):
    visits = [FX.visit(51, 0, "2_7"), FX.visit(51, 24, "6", 5.0, visit_id=7), FX.visit(51, 300, "3_6"),
              FX.visit(51, 700, "8_4", 6.0, visit_id=7)]
    touches = _touches(spark, visits)
    ends = L.chain_ends(touches, 90)
    ch = C.lookback_chains(touches, ends)
    assert {(r.conv_gidx, r.chain_length) for r in ch.collect()} == {(2, 2), (4, 4)}
    assert sorted(r.chain_length for r in ch.where("is_converting = 1").collect()) == [2, 4]
    assert sum(r.credit for r in L.lookback_last_touch(touches).collect()) == 2.0
    assert sum(r.credit for r in L.lookback_linear(touches, ends, 90).collect()) == pytest.approx(2.0)


def test_a_visitor_with_a_third_of_all_visits(spark):
    visits = [FX.visit(61, i / 50, ("2_7", "0", "3_6")[i % 3], 1.0 if i % 17 == 0 else None) for i in range(400)]
    visits += [FX.visit(100 + i, i % 90, "8_4", 2.0 if i % 4 == 0 else None) for i in range(800)]
    t = _touches(spark, visits, n_chunks=12)
    assert t.where("user_id = 61").select("_chunk").distinct().count() > 2
    chains = FX.session_chains(visits)
    for name in ("linear", "last_significant"):
        assert _by_day(MODELS[name](t), "visits", "conversions", "revenue") == FX.credit(chains, name)
    s = sessionize(prepare_visits(FX.raw(spark, visits), FX.COUNTER, FX.GOAL), timeout=FX.SESSION_GAP, n_chunks=12)
    blocks = C.touch_blocks(s, 16)
    assert blocks.agg(F.max(F.size("touches")), F.sum(F.size("touches"))).first() == (16, 1200)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_chunk" not in plan  # a hot session's touches stay in the chunks that hold them
    assert s.where("user_id = 61 and session_id = 1").select("_chunk").distinct().count() > 2
    assert C.chain_paths(C.build_chains(s)).agg(F.sum("chain_length")).first()[0] == sum(map(len, chains))


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_quantile_is_exact_over_bins(spark, q):
    values = [(i * i * i) % 1_000_003 for i in range(777)] + [5] * 300 + [1 << 40]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long").repartition(5)
    row = quantile_row(df, "v", q)
    assert row.first().value == pytest.approx(float(np.quantile(values, q)), rel=1e-12)
    assert quantile_row(df.where("v < 0"), "v", q).first().value is None
    assert quantile_row(df.where("v = 5"), "v", q).first().value == 5


def test_timeout_row_is_lazy(spark):
    """No job runs while the row is planned, whatever the gaps."""
    gaps = spark.range(100).select(F.lit(7).cast("long").alias("goal_id"), F.when(
        F.col("id") >= 0, F.raise_error(F.lit("evaluated"))).cast("long").alias("gap"))
    timeout_row(gaps)
    few = spark.createDataFrame([(1, 10), (1, 20), (2, 900), (2, 900), (1, 0)], "goal_id long, gap long")
    assert timeout_row(few, 1.0).first().timeout_seconds == 20
    assert timeout_row(few.where("gap = 0")).first().timeout_seconds == 1800


@pytest.mark.parametrize("n_chunks", [1, 5])
def test_models_match_explicit_chains(spark, n_chunks):
    """Array-free models equal unnesting every session prefix (the reference's form)."""
    p = prepare_visits(raw_visits(spark, SF), 1, 99)
    s = sessionize(p, n_chunks=n_chunks)
    t = M.touch_table(s)
    ch = C.build_chains(s).select("visit_id", F.to_date(F.col("history")[F.size("history") - 1]["utc_start_time"])
                                  .alias("d"), "conversions", "history")
    x = ch.select("d", "conversions", F.size("history").alias("n"), F.posexplode("history").alias("i", "h"))
    lin = (x.groupBy("d", F.col("h.source_code").alias("source_code"))
           .agg(F.sum(F.col("conversions") / F.col("n")).alias("conversions")))
    got = {(r.start_date, r.source_code): round(r.conversions, 9) for r in M.linear(t).collect()}
    exp = {(r.d, r.source_code): round(r.conversions, 9) for r in lin.collect()}
    assert got == exp


def test_fused_job_equals_the_model_functions(spark):
    """attribution_all (one spread join, one final aggregation) against each model on its own."""
    p = prepare_visits(raw_visits(spark, SF), 1, 99)
    t = M.touch_table(sessionize(p))
    cols = ["attribution_type", "start_date", "source_code", "visits", "conversions", "revenue",
            "assisted_conversions", "assisted_revenue"]
    zero = [F.lit(0.0).alias("assisted_conversions"), F.lit(0.0).alias("assisted_revenue")]
    parts = [M.last_touch_with_assists(t).select(*cols)] + [
        f(t).select(*cols[:6], *zero) for f in (M.first_touch, M.last_significant, M.linear, M.time_decay)]
    expected = parts[0]
    for part in parts[1:]:
        expected = expected.unionByName(part)

    def rows(df):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())

    assert rows(M.attribution_all(t)) == rows(expected)


def _rows_shuffled(plan):
    """Rows that each exchange of an executed plan has written."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _rows_shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _rows_shuffled(plan.plan())
    own = [plan.metrics().get("shuffleRecordsWritten").get().value()] if kind == "ShuffleExchangeExec" else []
    return sum((_rows_shuffled(plan.children().apply(i)) for i in range(plan.children().size())), own)


def test_later_days_of_sessions_are_not_shuffled(spark):
    """Thirty sessions of 40 days and ten channels: one visit a day, but 11,700 (session, channel, later day) rows a model."""
    visits = [FX.visit(user, i / 5, f"2_{i + 1}") for user in range(501, 531) for i in range(10)]
    visits += [FX.visit(user, 24 * day, "7", 5.0) for user in range(501, 531) for day in range(1, 40)]
    t = _touches(spark, visits, timeout=10 ** 6)
    found = M.attribution_all(t)
    rows = found.where("attribution_type = 'linear'").count()
    found.collect()
    assert rows == 10 + 39 * 11
    assert max(_rows_shuffled(found._jdf.queryExecution().executedPlan())) < 6000


def test_a_channel_earns_on_days_without_its_touches(spark):
    """Days before, between and after a channel's touches, with first days in the middle, against the plain reckoning."""
    visits = [FX.visit(user, 24 * day + h, code, paid) for user in (601, 602) for day, h, code, paid in (
        (0, 1, "2_1", None), (1, 2, "7", 3.0), (1, 3, "2_1", None), (4, 1, "3_2", 8.0), (6, 5, "2_1", 2.0), (6, 6, "7", None),
        (9, 1, "3_2", 4.0))]
    chains = FX.session_chains(visits, 10 ** 6)
    found = M.attribution_all(_touches(spark, visits, timeout=10 ** 6))
    for name in MODELS:
        assert _by_day(found.where(F.col("attribution_type") == name), "visits", "conversions", "revenue") == FX.credit(chains, name), name
    got = _by_day(found.where("attribution_type = 'last_touch' AND assisted_conversions > 0"), "assisted_conversions", "assisted_revenue")
    ends = {(c[-1]["at"].date(), c[-1]["code"]) for c in chains}
    assert got == {k: v for k, v in FX.assists(chains).items() if k in ends} and got
