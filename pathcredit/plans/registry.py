"""Registered queries: one Spark job per operator and its DuckDB oracle SQL.

Every job reads the test tables (visits are derived from ``events``), runs over
whole tables, and rounds floating outputs to 4 decimals, as the oracle does.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathcredit.config import ensure_checkpoint_dir, ensure_partitions, ensure_utc
from pathcredit.constants import ATTRIBUTION_GOAL_TYPES, DICTIONARY_FILES, TOP_SOURCES
from pathcredit.functions.codes import goal_hits, goal_revenue, primary_touch, root_id, source_code, sub_id
from pathcredit.operators import chains as C
from pathcredit.operators import lookback as L
from pathcredit.operators import models as M
from pathcredit.operators import views as V
from pathcredit.operators.prepare import collapse, flatten_touch, prepare_visits
from pathcredit.operators.sessions import event_timeline, session_breaks, session_timeout, sessionize, \
    user_last_close, visit_gaps
from pathcredit.plans import checks as G
from pathcredit.plans import marts as MT
from pathcredit.plans import oracle as O
from pathcredit.plans.attribution import COMBINED, PREPARED, RESULTS, run_daily, run_for
from pathcredit.sources import goals as GL
from pathcredit.sources import sinks
from pathcredit.sources.dictionaries import BUNDLED_DIR, load_dictionary
from pathcredit.sources.visits import denormalise_nested, normalise_nested, raw_visits, read_table, scan_visits, \
    with_week, write_raw_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RESULT = ["goal_id", "attribution_type", "start_date", "source_code", "visits", "conversions", "revenue"]
FIXED_STAMP_1 = dt.datetime(2024, 2, 1)
FIXED_STAMP_2 = dt.datetime(2024, 2, 2)


def round4(c):
    """Round to 4 decimals the same way as the oracle: first to 8 decimals, which removes
    last-bit differences from summation order, then half up with plain double arithmetic."""
    return F.floor(F.round(c, 8) * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[round4(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def query(name: str, sql: str | None, floats: tuple[str, ...] = ()):
    """Register a Spark job; ``sql`` is the oracle's final SELECT over the oracle CTEs."""
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            ensure_partitions(spark, read_table(spark, sf_dir, "events").count())
            return rounded(fn(spark, sf_dir))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _oracle(sql, floats)
        return fn
    return wrap


def _oracle(select: str, floats: tuple[str, ...]) -> str:
    needs = select
    ctes = [O.base_ctes(), O.prep_cte()]
    if re.search(r"\b(g|tmo|mk|tl|seq|vs|cp)\b", needs) or any(
            x in needs for x in ("m_", "nres", "ntr", "along", "lb")):
        ctes.append(O.session_ctes())
    if any(x in needs for x in ("m_", "nres", "ntr", "along")):
        ctes.append(O.model_ctes())
    if any(x in needs for x in ("nres", "ntr", "along", "dct")):
        ctes.append(O.named_ctes())
    if "lb" in needs:
        ctes.append(O.lookback_ctes())
    if "m_all3" in needs:
        ctes += [O.prep_cte((42,), "p3"), O.session_ctes("p3", "3"), O.model_ctes(14.0, "3")]
    if "m_all4" in needs:
        ctes.append(O.model_ctes(14.0, "4", cps=""))
    body = "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + f",\nq AS ({select})\n"
    if floats:
        repl = ", ".join(f"FLOOR(ROUND({f}, 8) * 10000.0 + 0.5) / 10000.0 AS {f}" for f in floats)
        return body + f"SELECT * REPLACE ({repl}) FROM q"
    return body + "SELECT * FROM q"


def _run(spark, sf_dir, **kw):
    return run_for(spark, sf_dir, **kw)


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pathcredit-{name}-{uuid.uuid4().hex}"


def _ts(col: str, alias: str):
    return F.unix_seconds(F.col(col)).alias(alias)


# ---------------------------------------------------------------- A. sources, sinks

@query("raw_visit_scan", """
  SELECT counter_id, user_id, visit_id, start_date, ts, visit_version, CAST(sign AS INTEGER) AS sign,
         CAST(hits99 + hits42 AS INTEGER) AS n_goals FROM raw WHERE counter_id = 1""")
def _(spark, sf):
    raw = scan_visits(spark, raw_visits(spark, sf), counter_id=1)
    return raw.select("counter_id", "user_id", "visit_id", "start_date", _ts("utc_start_time", "ts"),
                      "visit_version", F.col("sign").cast("int").alias("sign"), F.size("goals").alias("n_goals"))


@query("visits_per_week", """
  SELECT CAST(date_trunc('week', start_date) AS DATE) AS week, counter_id, COUNT(*) AS deliveries,
         COUNT(DISTINCT visit_id) AS visits FROM raw GROUP BY 1, 2""")
def _(spark, sf):
    return with_week(raw_visits(spark, sf)).groupBy("week", "counter_id").agg(
        F.count("*").alias("deliveries"), F.count_distinct("visit_id").alias("visits"))


ALL_FLOATS = ("visits", "conversions", "revenue", "assisted_conversions", "assisted_revenue")


@query("attribution_all", "SELECT * FROM m_all", ALL_FLOATS)
def _(spark, sf):
    return _run(spark, sf).results.drop("calculated_at")


@query("nested_normalise", """
  SELECT counter_id, visit_id, visit_version, CAST(sign AS INTEGER) AS sign, 2 AS n_touches,
         source_code, CAST(hits99 AS BIGINT) AS conversions FROM coded_raw""")
def _(spark, sf):
    flat = denormalise_nested(raw_visits(spark, sf))
    back = normalise_nested(flat)
    t = back.withColumn("_t", primary_touch("traffic_source"))
    return t.select("counter_id", "visit_id", "visit_version", F.col("sign").cast("int").alias("sign"),
                    F.size("traffic_source").alias("n_touches"), source_code("_t").alias("source_code"),
                    goal_hits("goals", 99).alias("conversions"))


@query("unsigned_ids", """
  SELECT CAST(CAST(user_id AS HUGEINT) + 9223372036854775808 AS VARCHAR) AS user_id,
         CAST(CAST(visit_id AS HUGEINT) + 9223372036854775808 AS VARCHAR) AS visit_id, session_id,
         CAST(pos AS BIGINT) AS pos FROM vs""")
def _(spark, sf):
    """Ids beyond 2**63 - 1, as the export's unsigned numbers may be, from source to sessions."""
    flat = denormalise_nested(raw_visits(spark, sf))
    wide = {c: (F.col(c).cast("decimal(20,0)") + F.lit(Decimal(2 ** 63))).cast("decimal(20,0)")
            for c in ("CounterUserIDHash", "VisitID")}
    raw = normalise_nested(flat.withColumns(wide))
    s = sessionize(prepare_visits(raw, 1, 99))
    return s.select(F.col("user_id").cast("string"), F.col("visit_id").cast("string"), "session_id", "pos")


def _dict_query(root: int, filename: str):
    @query(f"dict_load_{filename[:-4]}", f"""
      SELECT CAST(sub_id AS INTEGER) AS id, d.name, COUNT(*) AS visits
      FROM (SELECT COALESCE(TRY_CAST(split_part(source_code, '_', 2) AS INTEGER), 0) AS sub_id
            FROM p WHERE TRY_CAST(split_part(source_code, '_', 1) AS SMALLINT) = {root}) x
      LEFT JOIN (SELECT * FROM dct WHERE root_id = {root}) d ON d.id = x.sub_id
      GROUP BY 1, 2""")
    def _(spark, sf):
        d = load_dictionary(spark, os.path.join(BUNDLED_DIR, filename))
        d = d.groupBy("id").agg(F.min("name").alias("name"))
        codes = _run(spark, sf).prepared.where(root_id("source_code") == root).select(
            sub_id("source_code").alias("id"))
        return codes.join(d, "id", "left").groupBy("id", "name").agg(F.count("*").alias("visits"))


for _root, _fn in DICTIONARY_FILES.items():
    _dict_query(_root, _fn)


@query("goal_partition_replace", """
  SELECT * FROM m_all WHERE goal_id = 99
  UNION ALL SELECT * FROM m_all3 WHERE goal_id = 42""", ALL_FLOATS)
def _(spark, sf):
    path = _scratch(spark, "goal-replace")
    run = _run(spark, sf, goal_ids=(99, 42))
    sinks.replace_goals(run.results.drop("calculated_at"), path, (99, 42))
    redo = run.again(42, half_life=14.0).results.drop("calculated_at")
    sinks.replace_goals(redo, path, (42,))
    return spark.read.parquet(path).select(*RESULT, "assisted_conversions", "assisted_revenue")


@query("results_latest", """
  SELECT * FROM m_all WHERE attribution_type <> 'time_decay'
  UNION ALL SELECT * FROM m_all4 WHERE attribution_type = 'time_decay'""", ALL_FLOATS)
def _(spark, sf):
    a = _run(spark, sf).results.drop("calculated_at").withColumn("calculated_at", F.lit(FIXED_STAMP_1))
    b = (M.time_decay(_run(spark, sf).touches, 14.0)
         .withColumn("assisted_conversions", F.lit(0.0)).withColumn("assisted_revenue", F.lit(0.0))
         .withColumn("calculated_at", F.lit(FIXED_STAMP_2)))
    keys = ["goal_id", "attribution_type", "start_date", "source_code"]
    return sinks.latest_by(a.unionByName(b), keys).drop("calculated_at")


def _catalogue_values() -> str:
    import json
    with open(GL.BUNDLED_CATALOGUE, encoding="utf-8") as fh:
        goals = json.load(fh)["goals"]
    rows = [f"({int(g['id'])}, {O._q(g.get('name') or '')}, {O._q(g.get('type') or '')})" for g in goals
            if int(g.get("is_retargeting", 0)) != 1 and g.get("type") in ATTRIBUTION_GOAL_TYPES]
    return "(VALUES " + ", ".join(rows) + ") AS c(goal_id, name, type)"


@query("usable_goals", f"""
  SELECT CAST(c.goal_id AS BIGINT) AS goal_id, c.name, c.type, CAST(COALESCE(h.hits, 0) AS BIGINT) AS hits
  FROM {_catalogue_values()}
  LEFT JOIN (SELECT 99 AS goal_id, SUM(hits99) AS hits FROM raw UNION ALL
             SELECT 42, SUM(hits42) FROM raw) h ON h.goal_id = c.goal_id""")
def _(spark, sf):
    cat = GL.read_goal_catalogue(spark)
    return GL.goal_hits(raw_visits(spark, sf), cat).select("goal_id", "name", "type", "hits")


# ---------------------------------------------------------------- B. dedup and derivation

@query("collapse_live_visits", "SELECT counter_id, user_id, visit_id, start_date, visit_version FROM live")
def _(spark, sf):
    return collapse(raw_visits(spark, sf)).select("counter_id", "user_id", "visit_id", "start_date",
                                                  "visit_version")


@query("latest_version", "SELECT counter_id, visit_id, visit_version, duration, source_code FROM coded")
def _(spark, sf):
    live = flatten_touch(collapse(raw_visits(spark, sf)))
    return live.select("counter_id", "visit_id", "visit_version", "duration", "source_code")


@query("primary_touch", """
  SELECT visit_id, tsid AS traffic_source_id, se_root AS search_engine_root_id, adv AS adv_engine_id,
         social AS social_network_id, rec AS recommendation_system_id, msg AS messenger_id,
         banner AS click_banner_id, target AS click_target_type FROM live""")
def _(spark, sf):
    t = collapse(raw_visits(spark, sf)).select("visit_id", primary_touch("traffic_source").alias("t"))
    return t.select("visit_id", F.col("t.id").alias("traffic_source_id"),
                    *[F.col(f"t.{c}").alias(c) for c in (
                        "search_engine_root_id", "adv_engine_id", "social_network_id", "recommendation_system_id",
                        "messenger_id", "click_banner_id", "click_target_type")])


@query("source_code", "SELECT counter_id, visit_id, source_code FROM coded")
def _(spark, sf):
    return flatten_touch(collapse(raw_visits(spark, sf))).select("counter_id", "visit_id", "source_code")


@query("goal_hits", """
  SELECT visit_id, CAST(hits99 AS BIGINT) AS hits_99, CAST(hits42 AS BIGINT) AS hits_42 FROM live""")
def _(spark, sf):
    live = collapse(raw_visits(spark, sf))
    return live.select("visit_id", goal_hits("goals", 99).alias("hits_99"), goal_hits("goals", 42).alias("hits_42"))


@query("goal_revenue", "SELECT visit_id, CAST(hits99 * price99 / 1e6 AS DOUBLE) AS revenue_99 FROM live",
       ("revenue_99",))
def _(spark, sf):
    return collapse(raw_visits(spark, sf)).select("visit_id", goal_revenue("goals", 99).alias("revenue_99"))


@query("prepare_visits", """
  SELECT goal_id, counter_id, user_id, visit_id, start_date, ts, duration, source_code, conversions, revenue
  FROM p""", ("revenue",))
def _(spark, sf):
    p = _run(spark, sf).prepared
    return p.select("goal_id", "counter_id", "user_id", "visit_id", "start_date", _ts("utc_start_time", "ts"),
                    "duration", "source_code", "conversions", "revenue")


@query("prepare_from_store", """
  SELECT goal_id, counter_id, user_id, visit_id, start_date, ts, duration, source_code, conversions, revenue
  FROM p""", ("revenue",))
def _(spark, sf):
    """Prepared visits from a written raw store whose buckets hold all deliveries of their visits."""
    name = f"pathcredit_raw_{uuid.uuid4().hex}"
    write_raw_table(raw_visits(spark, sf), name, _scratch(spark, "raw"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    p = prepare_visits(scan_visits(spark, name, 1), 1, 99)
    return p.select("goal_id", "counter_id", "user_id", "visit_id", "start_date", _ts("utc_start_time", "ts"),
                    "duration", "source_code", "conversions", "revenue")


@query("split_source_code", """
  SELECT DISTINCT source_code, TRY_CAST(split_part(source_code, '_', 1) AS SMALLINT) AS root_id,
         COALESCE(TRY_CAST(split_part(source_code, '_', 2) AS INTEGER), 0) AS sub_id FROM p""")
def _(spark, sf):
    p = _run(spark, sf).prepared.select("source_code").distinct()
    return p.select("source_code", root_id("source_code").alias("root_id"), sub_id("source_code").alias("sub_id"))


# ---------------------------------------------------------------- C. sessions and chains

@query("visit_gaps", "SELECT goal_id, user_id, visit_id, ts, ts - gap AS prev_ts, gap FROM g WHERE gap IS NOT NULL")
def _(spark, sf):
    g = visit_gaps(_run(spark, sf).prepared).where(F.col("prev_ts").isNotNull())
    return g.select("goal_id", "user_id", "visit_id", "ts", "prev_ts", "gap")


@query("session_timeout", "SELECT tmo AS timeout_seconds FROM tmo")
def _(spark, sf):
    return session_timeout(_run(spark, sf).prepared)


@query("session_breaks", """
  SELECT goal_id, counter_id, user_id, ets AS marker_ts, next_visit_id, gap_seconds FROM mk WHERE kind = 'break'""")
def _(spark, sf):
    b = session_breaks(_run(spark, sf).sessions)
    return b.select("goal_id", "counter_id", "user_id", _ts("marker_time", "marker_ts"), "next_visit_id",
                    "gap_seconds")


@query("user_last_close", """
  SELECT mk.goal_id, mk.counter_id, mk.user_id, ets AS marker_ts, v.visits FROM mk
  JOIN (SELECT goal_id, counter_id, user_id, COUNT(*) AS visits FROM p GROUP BY 1, 2, 3) v
    ON v.goal_id = mk.goal_id AND v.counter_id = mk.counter_id AND v.user_id = mk.user_id
  WHERE kind = 'close'""")
def _(spark, sf):
    c = user_last_close(_run(spark, sf).sessions)
    return c.select("goal_id", "counter_id", "user_id", _ts("marker_time", "marker_ts"), "visits")


@query("event_timeline", """
  SELECT goal_id, counter_id, user_id, ets AS event_ts, event_type, visit_id, source_code,
         ROW_NUMBER() OVER (PARTITION BY goal_id, counter_id, user_id ORDER BY ets, event_type, visit_id) AS position
  FROM tl""")
def _(spark, sf):
    t = event_timeline(_run(spark, sf).touches)
    return t.select("goal_id", "counter_id", "user_id", _ts("event_time", "event_ts"), "event_type", "visit_id",
                    "source_code", "position")


@query("sessionize", "SELECT goal_id, counter_id, user_id, visit_id, ts, session_id, CAST(pos AS BIGINT) AS pos FROM vs")
def _(spark, sf):
    return _run(spark, sf).sessions.select("goal_id", "counter_id", "user_id", "visit_id", "ts", "session_id", "pos")


@query("chains", """
  SELECT goal_id, counter_id, user_id, chain_id AS visit_id, d AS start_date, CAST(MAX(len) AS BIGINT) AS chain_length,
         string_agg(src, ' > ' ORDER BY jpos) AS path, string_agg(CAST(jvid AS VARCHAR), ' > ' ORDER BY jpos) AS visit_ids,
         string_agg(CAST(jts AS VARCHAR), ' > ' ORDER BY jpos) AS times, string_agg('2_VISIT', ' > ' ORDER BY jpos) AS event_types,
         string_agg(CAST(jc AS VARCHAR), ' > ' ORDER BY jpos) AS touch_conversions, MAX(c) AS conversions, MAX(r) AS revenue
  FROM cp GROUP BY goal_id, counter_id, user_id, chain_id, d""", ("conversions", "revenue"))
def _(spark, sf):
    return C.chain_paths(_run(spark, sf).chains)


@query("lookback_chains", """
  SELECT goal_id, counter_id, user_id, conv_visit_id, visit_id, source_code, CAST(position AS BIGINT) AS position,
         CAST(chain_length AS BIGINT) AS chain_length, days_before_conv, is_converting FROM lb""",
       ("days_before_conv",))
def _(spark, sf):
    return _run(spark, sf).lookback.select(
        "goal_id", "counter_id", "user_id", "conv_visit_id", "visit_id", "source_code", "position",
        "chain_length", "days_before_conv", "is_converting")


# ---------------------------------------------------------------- D. models

MODEL_FLOATS = ("visits", "conversions", "revenue")
for _key, _cte, _fn in (("first_touch", "m_first", M.first_touch), ("last_touch", "m_last", M.last_touch),
                        ("last_significant", "m_lsig", M.last_significant), ("linear", "m_lin", M.linear)):
    query(_key, f"SELECT * FROM {_cte}", MODEL_FLOATS)(
        (lambda f: lambda spark, sf: f(_run(spark, sf).touches).select(*RESULT))(_fn))


@query("time_decay", "SELECT * FROM m_dec", MODEL_FLOATS)
def _(spark, sf):
    return M.time_decay(_run(spark, sf).touches).select(*RESULT)


@query("assisted", "SELECT * FROM m_ast", ("assisted_conversions", "assisted_revenue"))
def _(spark, sf):
    return M.assisted(_run(spark, sf).touches)


@query("last_touch_assisted", "SELECT * FROM m_lta", ALL_FLOATS)
def _(spark, sf):
    return M.last_touch_with_assists(_run(spark, sf).touches).select(*RESULT, "assisted_conversions",
                                                                      "assisted_revenue")


@query("source_transitions", "SELECT * FROM m_tr", ("transitions", "converting_chains"))
def _(spark, sf):
    return _run(spark, sf).transitions.drop("calculated_at")


LB = "goal_id, source_code"
for _key, _sql, _fn in (
    ("lookback_first_touch", f"SELECT {LB}, CAST(COUNT(*) AS DOUBLE) AS credit FROM lb WHERE position = 1 GROUP BY 1, 2",
     lambda r: L.lookback_first_touch(r.touches, r.lookback_ends)),
    ("lookback_last_touch", f"SELECT {LB}, CAST(COUNT(*) AS DOUBLE) AS credit FROM lb WHERE is_converting = 1 GROUP BY 1, 2",
     lambda r: L.lookback_last_touch(r.touches)),
    ("lookback_last_significant", """SELECT lb.goal_id, lb.source_code, CAST(COUNT(*) AS DOUBLE) AS credit FROM lb
       JOIN lbsig s ON s.goal_id = lb.goal_id AND s.counter_id = lb.counter_id AND s.user_id = lb.user_id
        AND s.conv_visit_id = lb.conv_visit_id AND lb.position = s.sp GROUP BY 1, 2""", lambda r: L.lookback_last_significant(r.lookback_ends)),
    ("lookback_linear", f"SELECT {LB}, SUM(1.0 / chain_length) AS credit FROM lb GROUP BY 1, 2", lambda r: L.lookback_linear(r.touches, r.lookback_ends, r.lookback_days)),
    ("lookback_time_decay", f"SELECT {LB}, SUM(w / tw) AS credit FROM lbw GROUP BY 1, 2", 
     lambda r: L.lookback_time_decay(r.touches, r.lookback_ends, r.lookback_days)),
    ("lookback_assisted", f"""SELECT {LB}, CAST(COUNT(*) AS DOUBLE) AS credit FROM
       (SELECT DISTINCT goal_id, counter_id, user_id, conv_visit_id, source_code FROM lb WHERE position < chain_length)
       GROUP BY 1, 2""", lambda r: L.lookback_assisted(r.touches, r.lookback_days)),
):
    query(_key, _sql, ("credit",))((lambda f: lambda spark, sf: f(_run(spark, sf)))(_fn))


@query("lookback_transitions", """
  SELECT a.goal_id, a.source_code AS prev_source_code, b.source_code AS next_source_code,
         CAST(COUNT(*) AS DOUBLE) AS transitions
  FROM lb a JOIN lb b ON a.goal_id = b.goal_id AND a.counter_id = b.counter_id AND a.user_id = b.user_id
   AND a.conv_visit_id = b.conv_visit_id AND b.position = a.position + 1 GROUP BY 1, 2, 3""", ("transitions",))
def _(spark, sf):
    r = _run(spark, sf)
    return L.lookback_transitions(r.touches, r.lookback_days)


# ---------------------------------------------------------------- E. named views

NAMED = [*RESULT, "assisted_conversions", "assisted_revenue", "source_name"]


@query("v_attribution_results", f"SELECT {', '.join(NAMED)} FROM nres", ALL_FLOATS)
def _(spark, sf):
    return _run(spark, sf).named_results.select(*NAMED)


TR_NAMED = ["goal_id", "start_date", "prev_source_code", "next_source_code", "transitions", "converting_chains",
            "prev_source_name", "next_source_name"]


@query("v_source_transitions", f"SELECT {', '.join(TR_NAMED)} FROM ntr", ("transitions", "converting_chains"))
def _(spark, sf):
    return _run(spark, sf).named_transitions.select(*TR_NAMED)


@query("v_assisted_long", "SELECT * FROM along", ("value", "value_money"))
def _(spark, sf):
    return _run(spark, sf).assisted_long


# ---------------------------------------------------------------- F. dashboard

@query("kpi_touchpoints", """
  SELECT COUNT(*) AS converting_chains, AVG(pos) AS avg_touchpoints FROM vs WHERE conversions > 0""",
       ("avg_touchpoints",))
def _(spark, sf):
    return MT.kpi_touchpoints(_run(spark, sf).touches)


@query("kpi_touchpoints_period", """
  SELECT COUNT(*) AS converting_chains, AVG(pos) AS avg_touchpoints FROM vs
  WHERE conversions > 0 AND CAST(utc_start_time AS DATE) > (SELECT MAX(CAST(utc_start_time AS DATE)) FROM vs) - INTERVAL 30 DAY
   AND CAST(utc_start_time AS DATE) <= (SELECT MAX(CAST(utc_start_time AS DATE)) FROM vs)""", ("avg_touchpoints",))
def _(spark, sf):
    """The dashboard's default period: the last 30 days that have chains."""
    t = _run(spark, sf).touches
    last = t.agg(F.max("chain_date")).first()[0]
    return MT.kpi_touchpoints(t, start=last and last - dt.timedelta(days=29), end=last)


@query("chain_steps", """
  SELECT a.src AS from_channel, b.src AS to_channel, CAST(a.jpos AS BIGINT) AS step, COUNT(*) AS visits,
         SUM(a.c) AS conversions
  FROM cp a JOIN cp b ON a.goal_id = b.goal_id AND a.counter_id = b.counter_id AND a.user_id = b.user_id
   AND a.chain_id = b.chain_id AND b.jpos = a.jpos + 1
  GROUP BY 1, 2, 3 HAVING COUNT(*) >= 5""", ("conversions",))
def _(spark, sf):
    return MT.chain_steps(_run(spark, sf).touches)


def _rank_sql(src: str, dims: list[str], among: list[str], measure: str, n: int) -> str:
    others = [d for d in dims if d not in among]
    part = f"PARTITION BY {', '.join(others)} " if others else ""
    return f"""
  SELECT g.*, r.rank FROM (SELECT {', '.join(dims)}, SUM({measure}) AS {measure} FROM {src} GROUP BY {', '.join(dims)}) g
  JOIN (SELECT * FROM (SELECT {', '.join(dims)}, DENSE_RANK() OVER ({part}ORDER BY {measure} DESC) AS rank
        FROM (SELECT {', '.join(dims)}, SUM({measure}) AS {measure} FROM {src} GROUP BY {', '.join(dims)}))
        WHERE rank <= {n}) r USING ({', '.join(dims)})"""


@query("channel_ratios", """
  SELECT attribution_type, source_code, source_name, SUM(visits) AS visits, SUM(conversions) AS conversions,
         SUM(revenue) AS revenue,
         CASE WHEN SUM(visits) = 0 THEN NULL ELSE SUM(conversions) / SUM(visits) END AS conversion_rate,
         CASE WHEN SUM(visits) = 0 THEN NULL ELSE SUM(revenue) / SUM(visits) END AS revenue_per_visit,
         CASE WHEN SUM(conversions) = 0 THEN NULL ELSE SUM(revenue) / SUM(conversions) END AS revenue_per_conversion
  FROM nres GROUP BY 1, 2, 3""",
       ("visits", "conversions", "revenue", "conversion_rate", "revenue_per_visit", "revenue_per_conversion"))
def _(spark, sf):
    return MT.channel_ratios(_run(spark, sf).named_results)


@query("top_sources", _rank_sql("nres", ["attribution_type", "source_name"], ["source_name"], "conversions", 10),
       ("conversions",))
def _(spark, sf):
    return MT.top_sources(_run(spark, sf).named_results)


@query("top_transitions", _rank_sql("ntr", ["prev_source_name", "next_source_name"],
                                    ["prev_source_name", "next_source_name"], "transitions", 100), ("transitions",))
def _(spark, sf):
    return MT.top_transitions(_run(spark, sf).named_transitions)


@query("model_names", f"""
  SELECT attribution_type, {O.model_name_sql('attribution_type')} AS model_name, COUNT(*) AS rows
  FROM m_all GROUP BY 1""")
def _(spark, sf):
    return MT.model_names(_run(spark, sf).results)


@query("kpi_linear", """
  SELECT SUM(revenue) AS revenue, SUM(conversions) AS conversions FROM nres WHERE attribution_type = 'linear'""",
       ("revenue", "conversions"))
def _(spark, sf):
    return MT.kpi_linear(_run(spark, sf).named_results)


@query("model_mix", "SELECT *, conversions / SUM(conversions) OVER (PARTITION BY attribution_type) AS share FROM ("
       + _rank_sql("nres", ["attribution_type", "source_name"], ["source_name"], "conversions", 10) + ")",
       ("conversions", "share"))
def _(spark, sf):
    return MT.model_mix(_run(spark, sf).named_results)


@query("source_time_series", _rank_sql("(SELECT * FROM nres WHERE attribution_type = 'linear')",
                                       ["start_date", "source_name"], ["source_name"], "conversions", 10),
       ("conversions",))
def _(spark, sf):
    return MT.source_time_series(_run(spark, sf).named_results)


@query("source_by_model", f"SELECT *, {O.model_name_sql('attribution_type')} AS model_name FROM ("
       + _rank_sql("nres", ["attribution_type", "source_name"], ["source_name"], "conversions", 10) + ")",
       ("conversions",))
def _(spark, sf):
    return MT.source_by_model(_run(spark, sf).named_results)


@query("direct_vs_assisted", _rank_sql("along", ["source_name", "metric_type"], ["source_name"], "value", 10),
       ("value",))
def _(spark, sf):
    return MT.direct_vs_assisted(_run(spark, sf).assisted_long)


@query("transition_matrix", """
  SELECT prev_source_name, next_source_name, SUM(transitions) AS transitions,
         CAST(GROUPING(prev_source_name, next_source_name) AS INTEGER) AS total_level
  FROM (""" + _rank_sql("ntr", ["prev_source_name", "next_source_name"], ["prev_source_name", "next_source_name"],
                        "transitions", 100) + """) GROUP BY CUBE (prev_source_name, next_source_name)""",
       ("transitions",))
def _(spark, sf):
    return MT.transition_matrix(_run(spark, sf).named_transitions)


@query("source_model_pivot", f"""
  SELECT source_name, model_name, SUM(visits) AS visits, SUM(conversions) AS conversions, SUM(revenue) AS revenue,
         CASE WHEN SUM(conversions) = 0 THEN NULL ELSE SUM(revenue) / SUM(conversions) END AS revenue_per_conversion,
         CAST(GROUPING(source_name, model_name) AS INTEGER) AS total_level
  FROM (SELECT a.*, {O.model_name_sql('a.attribution_type')} AS model_name
        FROM (SELECT attribution_type, source_name, SUM(visits) AS visits, SUM(conversions) AS conversions,
                     SUM(revenue) AS revenue FROM nres GROUP BY 1, 2) a
        JOIN (SELECT attribution_type, source_name FROM ({_rank_sql('nres', ['attribution_type', 'source_name'],
                                                                    ['source_name'], 'conversions', 10)})) t
          USING (attribution_type, source_name))
  GROUP BY CUBE (source_name, model_name)""",
       ("visits", "conversions", "revenue", "revenue_per_conversion"))
def _(spark, sf):
    return MT.source_model_pivot(_run(spark, sf).named_results)


@query("selector_filter", f"""
  SELECT {', '.join(NAMED)} FROM nres WHERE attribution_type = 'linear'
   AND start_date > (SELECT MAX(start_date) FROM nres) - INTERVAL 30 DAY
   AND start_date <= (SELECT MAX(start_date) FROM nres)""", ALL_FLOATS)
def _(spark, sf):
    return MT.selector_filter(_run(spark, sf).named_results).select(*NAMED)


# ---------------------------------------------------------------- G. checks

@query("table_counts", """
  SELECT *, CAST(rows = 0 AS INTEGER) AS empty FROM (
  SELECT 'visits_raw' AS table_name, COUNT(*) AS rows FROM raw
  UNION ALL SELECT 'visits_prepared', COUNT(*) FROM p
  UNION ALL SELECT 'visits_combined', COUNT(DISTINCT (user_id, chain_id)) FROM cp
  UNION ALL SELECT 'attribution_results', COUNT(*) FROM m_all)""")
def _(spark, sf):
    out = _scratch(spark, "daily")
    run_daily(spark, raw_visits(spark, sf), out, 1, 99)
    written = {n: spark.read.parquet(f"{out}/{n}") for n in (PREPARED, COMBINED, RESULTS)}
    return G.table_counts(spark, {"visits_raw": raw_visits(spark, sf), **written})


@query("daily_checks", """
  SELECT 'table_rows' AS check_name, 'visits_prepared' AS subject, CAST(COUNT(*) AS DOUBLE) AS value FROM p
  UNION ALL SELECT 'table_rows', 'visits_combined', COUNT(DISTINCT (user_id, chain_id)) FROM cp
  UNION ALL SELECT 'table_rows', 'attribution_results', COUNT(*) FROM m_all
  UNION ALL SELECT 'table_rows', 'source_transitions', COUNT(*) FROM m_tr
  UNION ALL SELECT unnest(['rows', 'visits', 'conversions', 'revenue']), attribution_type,
    unnest([n, ROUND(v, 2), ROUND(c, 2), ROUND(r, 2)])
    FROM (SELECT attribution_type, CAST(COUNT(*) AS DOUBLE) AS n, SUM(visits) AS v, SUM(conversions) AS c, SUM(revenue) AS r
          FROM m_all GROUP BY 1)
  UNION ALL SELECT 'visit_invariant', 'all', CAST(COUNT(DISTINCT ROUND(s, 2)) <= 1 AS DOUBLE)
    FROM (SELECT SUM(visits) AS s FROM m_all GROUP BY attribution_type)
  UNION ALL SELECT 'conversion_invariant', attribution_type,
    CAST(ABS(SUM(conversions) - (SELECT SUM(conversions) FROM p)) < 1e-6 AS DOUBLE) FROM m_all GROUP BY 2""", ("value",))
def _(spark, sf):
    """Counts, sums and invariants as the daily job's own writes observed them."""
    return run_daily(spark, raw_visits(spark, sf), _scratch(spark, "daily"), 1, 99).checks


@query("model_summary", """
  SELECT attribution_type, COUNT(*) AS rows, ROUND(SUM(visits), 2) AS visits, ROUND(SUM(conversions), 2) AS conv,
         ROUND(SUM(revenue), 2) AS revenue FROM m_all GROUP BY 1""", ("visits", "conv", "revenue"))
def _(spark, sf):
    return G.model_summary(_run(spark, sf).results)


@query("model_count", "SELECT COUNT(DISTINCT attribution_type) AS n_models FROM m_all")
def _(spark, sf):
    return G.model_count(_run(spark, sf).results)


@query("visit_invariant", """
  SELECT COUNT(DISTINCT ROUND(s, 2)) AS distinct_visit_totals FROM
  (SELECT SUM(visits) AS s FROM m_all GROUP BY attribution_type)""")
def _(spark, sf):
    return G.visit_invariant(_run(spark, sf).results)


@query("conversion_invariant", """
  SELECT attribution_type, SUM(conversions) AS conversions, (SELECT CAST(SUM(conversions) AS DOUBLE) FROM p) AS expected,
         CASE WHEN ABS(SUM(conversions) - (SELECT SUM(conversions) FROM p)) < 1e-6 THEN 1 ELSE 0 END AS holds
  FROM m_all GROUP BY 1""", ("conversions", "expected"))
def _(spark, sf):
    r = _run(spark, sf)
    return G.conversion_invariant(r.results, r.touches)


@query("top5_last_touch", """
  SELECT source_code, ROUND(SUM(conversions), 2) AS conv, ROUND(SUM(visits), 2) AS visits FROM m_all
  WHERE attribution_type = 'last_touch' GROUP BY 1
  ORDER BY CASE WHEN (SELECT SUM(conversions) FROM m_all WHERE attribution_type = 'last_touch') > 0
           THEN ROUND(SUM(conversions), 2) ELSE ROUND(SUM(visits), 2) END DESC, source_code LIMIT 5""",
       ("conv", "visits"))
def _(spark, sf):
    return G.top5_last_touch(_run(spark, sf).results)


@query("goal_frequency", """
  SELECT goal_id, CAST(SUM(h) AS BIGINT) AS hits FROM (
    SELECT CAST(99 AS BIGINT) AS goal_id, hits99 AS h FROM raw UNION ALL SELECT CAST(42 AS BIGINT), hits42 FROM raw)
  GROUP BY 1 HAVING SUM(h) > 0 ORDER BY hits DESC, goal_id LIMIT 20""")
def _(spark, sf):
    return G.goal_frequency(raw_visits(spark, sf))
