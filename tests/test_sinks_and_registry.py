import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF
from pathcredit.operators import chains as C
from pathcredit.plans import checks as G
from pathcredit.plans.attribution import COMBINED, RESULTS, TOUCHES, TRANSITIONS, read_combined, run_daily
from pathcredit.plans.registry import ORACLES, QUERIES
from pathcredit.sources import sinks
from pathcredit.sources.visits import raw_visits


def test_replace_goal_keeps_other_goals(spark, tmp_path):
    path = str(tmp_path / "res")
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "goal_id long, k string, v double")
    sinks.replace_goals(a, path, (1, 2))
    b = spark.createDataFrame([(2, "z", 3.0)], "goal_id long, k string, v double")
    sinks.replace_goals(b, path, [2])
    rows = sorted((r.goal_id, r.k) for r in spark.read.parquet(path).collect())
    assert rows == [(1, "x"), (2, "z")]


def test_a_goal_without_rows_loses_its_old_ones(spark, tmp_path):
    path, schema = str(tmp_path / "res"), "k string, v double, goal_id long"
    rows = spark.createDataFrame([("x", 1.0, 1), ("y", 2.0, 2), ("z", 3.0, 3)], schema)
    sinks.replace_goals(rows, path, (1, 2, 3))
    seen = sinks.replace_goals(spark.createDataFrame([("new", 5.0, 1), ("not asked for", 6.0, 3)], schema), path, (1, 2),
                               F.sum("v").alias("total"))
    assert seen == {"total": 5.0}
    assert sorted((r.goal_id, r.k) for r in spark.read.parquet(path).collect()) == [(1, "new"), (3, "z")]
    sinks.replace_goals(spark.createDataFrame([], schema), path, (1, 3))
    assert spark.read.schema(schema).parquet(path).count() == 0


def test_a_rerun_whose_goal_lost_its_visits_leaves_nothing(spark, tmp_path):
    out, raw = str(tmp_path / "daily"), raw_visits(spark, SF)
    run_daily(spark, raw, out, 1, (99, 42))
    tables = (COMBINED, TOUCHES, RESULTS, TRANSITIONS)
    before = {t: spark.read.parquet(f"{out}/{t}").where("goal_id = 99").count() for t in tables}
    assert all(before.values())
    run = run_daily(spark, raw.where("visit_id < 0"), out, 1, 42)
    for t in tables:
        left = spark.read.parquet(f"{out}/{t}").groupBy("goal_id").count().collect()
        assert [tuple(r) for r in left] == [(99, before[t])], t
    assert {r.value for r in run.checks.where("check_name = 'table_rows'").collect()} == {0.0}


def test_daily_job_stores_each_touch_once_and_reads_whole_chains(spark, tmp_path):
    out, raw = str(tmp_path / "daily"), raw_visits(spark, SF)
    run = run_daily(spark, raw, out, 1, (99, 42))
    ends, blocks = (spark.read.parquet(f"{out}/{t}") for t in (COMBINED, TOUCHES))
    assert not any("array" in t for _, t in ends.dtypes)
    assert blocks.agg(F.sum(F.size("touches"))).first()[0] == ends.count() == run.touches.count()
    got = C.chain_paths(read_combined(spark, out, F.col("goal_id") == 42))
    want = C.chain_paths(run.chains.where("goal_id = 42"))
    assert got.count() == ends.where("goal_id = 42").count()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_daily_job_replaces_only_its_goals(spark, tmp_path):
    out, raw = str(tmp_path / "daily"), raw_visits(spark, SF)
    run_daily(spark, raw, out, 1, (99, 42))
    tables = (COMBINED, TOUCHES, RESULTS, TRANSITIONS)

    def rows(name, goal):
        df = spark.read.parquet(f"{out}/{name}").where(F.col("goal_id") == goal).drop("calculated_at")
        return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
                      for r in df.select(*sorted(df.columns)).collect())
    before = {(t, g): rows(t, g) for t in tables for g in (99, 42)}
    assert all(before.values())
    run_daily(spark, raw.where("visit_id < 700"), out, 1, 42, half_life=2.0)
    for t in tables:
        assert rows(t, 99) == before[t, 99]
        assert rows(t, 42) != before[t, 42]
    assert spark.read.parquet(f"{out}/visits_prepared").select("goal_id").distinct().count() == 1
    counts = {r.table_name: r.empty for r in G.table_counts(spark, {
        "full": raw, "none": raw.where("visit_id < 0")}).collect()}
    assert counts == {"full": 0, "none": 1}


def test_latest_by_picks_newest(spark):
    df = spark.createDataFrame([(1, 1.0, dt.datetime(2024, 1, 1)), (1, 2.0, dt.datetime(2024, 1, 2)),
                                (2, 5.0, dt.datetime(2024, 1, 1))], "k long, v double, calculated_at timestamp")
    got = {r.k: r.v for r in sinks.latest_by(df, ["k"]).collect()}
    assert got == {1: 2.0, 2: 5.0}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", ["attribution_all", "source_transitions", "v_attribution_results",
                                 "lookback_chains", "chains", "daily_checks", "chain_steps", "event_timeline", "usable_goals",
                                 "dict_load_search_engine_roots", "source_model_pivot"])
def test_query_matches_oracle(spark, key):
    s = QUERIES[key](spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    o = con.execute(ORACLES[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    cols = sorted(s.columns)

    def norm(df):
        out = []
        for row in df[cols].itertuples(index=False, name=None):
            vals = []
            for v in row:
                if hasattr(v, "date") and callable(v.date) and not isinstance(v, str):
                    v = v.date()
                if v is None or (isinstance(v, float) and v != v):
                    v = None
                elif isinstance(v, float):
                    v = round(v, 3)
                elif hasattr(v, "item"):
                    v = v.item()
                vals.append(str(v))
            out.append("|".join(vals))
        return sorted(out)

    assert norm(s) == norm(o)
