"""DuckDB oracle SQL for every registered query.

Written independently of the Spark jobs: visits come from scalar columns (no
arrays), sessions from the marker formulation (break markers at earlier visit +
timeout, closing markers, sorted timeline), and every chain is expanded
explicitly as (chain, touch) pairs before the models aggregate them.
"""

from __future__ import annotations

import csv
import json
import os

from pathcredit.constants import (
    ATTRIBUTION_GOAL_TYPES, DICTIONARY_FILES, METRIC_ASSISTED, METRIC_DIRECT, MISSING_NAME_PREFIX,
    MODEL_LABELS, NON_SIGNIFICANT_ROOTS, ROOT_LABELS, ROOT_PREFIXES,
)
from pathcredit.sources.dictionaries import BUNDLED_DIR
from pathcredit.sources.goals import BUNDLED_CATALOGUE

NONSIG = ", ".join(str(r) for r in NON_SIGNIFICANT_ROOTS)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def base_ctes() -> str:
    return """
ev AS (
  SELECT event_id, user_id, event_type, value, date_trunc('second', ts) AS t,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
del AS (
  SELECT *, 1 AS version, 1 AS sign, k AS kk FROM ev
  UNION ALL SELECT *, 1, -1, k FROM ev WHERE event_id % 10 = 0
  UNION ALL SELECT *, 2, 1, k + 1 FROM ev WHERE event_id % 10 = 0
  UNION ALL SELECT *, 1, -1, k FROM ev WHERE event_id % 10 <> 0 AND event_id % 17 = 0
  UNION ALL SELECT *, 3, 1, k + 2 FROM ev WHERE event_id % 10 <> 0 AND event_id % 17 <> 0 AND event_id % 23 = 0),
raw AS (
  SELECT CAST(CASE WHEN user_id % 10 = 0 THEN 2 ELSE 1 END AS BIGINT) AS counter_id, user_id,
         event_id AS visit_id, CAST(t AS DATE) AS start_date, t AS utc_start_time,
         CAST(epoch(t) AS BIGINT) AS ts, CAST(kk * 10 AS BIGINT) AS duration,
         CAST(version AS BIGINT) AS visit_version, sign,
         kk % 13 - 1 AS tsid, 25 + kk % 4 AS se_root, 1 + kk % 3 AS adv, 1 + kk % 6 AS social,
         2 + kk % 3 AS rec, 1 + kk % 5 AS msg, CAST((kk % 2) * (event_id + 1) AS BIGINT) AS banner,
         kk % 5 AS target,
         CASE WHEN event_type = 'purchase' THEN (CASE WHEN kk % 7 = 0 THEN 2 ELSE 1 END) ELSE 0 END AS hits99,
         value * 1e6 AS price99,
         CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS hits42
  FROM del),
live AS (
  SELECT * EXCLUDE (signs, rn) FROM (
    SELECT *, SUM(sign) OVER (PARTITION BY counter_id, user_id, visit_id, start_date) AS signs,
           ROW_NUMBER() OVER (PARTITION BY counter_id, user_id, visit_id, start_date
                              ORDER BY visit_version DESC, sign DESC) AS rn
    FROM raw) WHERE rn = 1 AND signs > 0),
coded AS (
  SELECT *, CAST(tsid AS VARCHAR) || CASE
      WHEN tsid = 2 THEN '_' || CAST(se_root AS VARCHAR)
      WHEN tsid = 3 AND adv = 1 AND banner <> 0 THEN '_' || CAST(adv AS VARCHAR) || '_' || CAST(target AS VARCHAR)
      WHEN tsid = 3 THEN '_' || CAST(adv AS VARCHAR)
      WHEN tsid = 8 THEN '_' || CAST(social AS VARCHAR)
      WHEN tsid = 9 THEN '_' || CAST(rec AS VARCHAR)
      WHEN tsid = 10 THEN '_' || CAST(msg AS VARCHAR)
      ELSE '' END AS source_code
  FROM live),
coded_raw AS (
  SELECT *, CAST(tsid AS VARCHAR) || CASE
      WHEN tsid = 2 THEN '_' || CAST(se_root AS VARCHAR)
      WHEN tsid = 3 AND adv = 1 AND banner <> 0 THEN '_' || CAST(adv AS VARCHAR) || '_' || CAST(target AS VARCHAR)
      WHEN tsid = 3 THEN '_' || CAST(adv AS VARCHAR)
      WHEN tsid = 8 THEN '_' || CAST(social AS VARCHAR)
      WHEN tsid = 9 THEN '_' || CAST(rec AS VARCHAR)
      WHEN tsid = 10 THEN '_' || CAST(msg AS VARCHAR)
      ELSE '' END AS source_code
  FROM raw)"""


def prep_cte(goals: tuple[int, ...] = (99,), name: str = "p") -> str:
    parts = []
    for g in goals:
        conv = "hits99" if g == 99 else ("hits42" if g == 42 else "0")
        rev = "hits99 * price99 / 1e6" if g == 99 else "0.0"
        parts.append(f"""SELECT CAST({g} AS BIGINT) AS goal_id, counter_id, user_id, visit_id, start_date,
         utc_start_time, ts, duration, source_code, CAST({conv} AS BIGINT) AS conversions,
         CAST({rev} AS DOUBLE) AS revenue
  FROM coded WHERE counter_id = 1""")
    return f"{name} AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


def session_ctes(p: str = "p", s: str = "") -> str:
    """Gaps, timeout, markers, timeline, sessions and explicit chain pairs ``cp{s}``."""
    return f"""
g{s} AS (
  SELECT *, ts - LAG(ts) OVER (PARTITION BY goal_id, counter_id, user_id ORDER BY ts, visit_id) AS gap FROM {p}),
tmo{s} AS (
  SELECT COALESCE(CASE WHEN FLOOR(quantile_cont(gap, 0.95)) > 0
                       THEN CAST(FLOOR(quantile_cont(gap, 0.95)) AS BIGINT) END, 1800) AS tmo
  FROM g{s} WHERE gap > 0 AND goal_id = (SELECT MIN(goal_id) FROM g{s})),
mk{s} AS (
  SELECT goal_id, counter_id, user_id, ts - gap + (SELECT tmo FROM tmo{s}) AS ets, visit_id AS next_visit_id,
         gap AS gap_seconds, 'break' AS kind
  FROM g{s} WHERE gap > (SELECT tmo FROM tmo{s})
  UNION ALL
  SELECT goal_id, counter_id, user_id, MAX(ts) + (SELECT tmo FROM tmo{s}), NULL, NULL, 'close'
  FROM g{s} GROUP BY goal_id, counter_id, user_id),
tl{s} AS (
  SELECT goal_id, counter_id, user_id, ts AS ets, '2_VISIT' AS event_type, visit_id, source_code FROM {p}
  UNION ALL
  SELECT goal_id, counter_id, user_id, ets, '0_NULL', CAST(0 AS BIGINT), 'null' FROM mk{s}),
seq{s} AS (
  SELECT *, SUM(CASE WHEN event_type = '0_NULL' THEN 1 ELSE 0 END) OVER (
              PARTITION BY goal_id, counter_id, user_id ORDER BY ets, event_type, visit_id
              ROWS UNBOUNDED PRECEDING) AS markers_before
  FROM tl{s}),
vs{s} AS (
  SELECT v.*, CAST(q.markers_before + 1 AS BIGINT) AS session_id,
         ROW_NUMBER() OVER (PARTITION BY v.goal_id, v.counter_id, v.user_id, q.markers_before
                            ORDER BY v.ts, v.visit_id) AS pos
  FROM {p} v JOIN seq{s} q ON q.event_type = '2_VISIT' AND q.goal_id = v.goal_id
       AND q.counter_id = v.counter_id AND q.user_id = v.user_id AND q.visit_id = v.visit_id),
cp{s} AS (
  SELECT i.goal_id, i.counter_id, i.user_id, i.visit_id AS chain_id, CAST(i.utc_start_time AS DATE) AS d,
         CAST(i.conversions AS DOUBLE) AS c, i.revenue AS r, i.ts AS its, i.pos AS len,
         j.source_code AS src, j.ts AS jts, j.pos AS jpos, j.visit_id AS jvid,
         j.conversions AS jc
  FROM vs{s} i JOIN vs{s} j ON i.goal_id = j.goal_id AND i.counter_id = j.counter_id
       AND i.user_id = j.user_id AND i.session_id = j.session_id AND j.pos <= i.pos)"""


def _sig(col: str) -> str:
    r = f"TRY_CAST(split_part({col}, '_', 1) AS SMALLINT)"
    return f"({r} IS NOT NULL AND {r} NOT IN ({NONSIG}))"


def model_ctes(half_life: float = 7.0, s: str = "", cps: str | None = None) -> str:
    h = float(half_life)
    src = f"cp{s if cps is None else cps}"
    res = "goal_id, attribution_type, start_date, source_code, visits, conversions, revenue"
    return f"""
m_first{s} AS (
  SELECT goal_id, 'first_touch' AS attribution_type, d AS start_date, src AS source_code,
         CAST(COUNT(*) AS DOUBLE) AS visits, SUM(c) AS conversions, SUM(r) AS revenue
  FROM {src} WHERE jpos = 1 GROUP BY goal_id, d, src),
m_last{s} AS (
  SELECT goal_id, 'last_touch' AS attribution_type, d AS start_date, src AS source_code,
         CAST(COUNT(*) AS DOUBLE) AS visits, SUM(c) AS conversions, SUM(r) AS revenue
  FROM {src} WHERE jpos = len GROUP BY goal_id, d, src),
sigpos{s} AS (
  SELECT goal_id, counter_id, user_id, chain_id, MAX(CASE WHEN {_sig('src')} THEN jpos END) AS sp
  FROM {src} GROUP BY goal_id, counter_id, user_id, chain_id),
m_lsig{s} AS (
  SELECT cp.goal_id, 'last_significant' AS attribution_type, cp.d AS start_date, cp.src AS source_code,
         CAST(COUNT(*) AS DOUBLE) AS visits, SUM(cp.c) AS conversions, SUM(cp.r) AS revenue
  FROM {src} cp JOIN sigpos{s} sp ON cp.goal_id = sp.goal_id AND cp.counter_id = sp.counter_id
       AND cp.user_id = sp.user_id AND cp.chain_id = sp.chain_id AND cp.jpos = COALESCE(sp.sp, cp.len)
  GROUP BY cp.goal_id, cp.d, cp.src),
m_lin{s} AS (
  SELECT goal_id, 'linear' AS attribution_type, d AS start_date, src AS source_code,
         SUM(1.0 / len) AS visits, SUM(c / len) AS conversions, SUM(r / len) AS revenue
  FROM {src} GROUP BY goal_id, d, src),
dw{s} AS (
  SELECT *, power(2.0, -((its - jts) / 86400.0 / {h})) AS w FROM {src}),
dwt{s} AS (
  SELECT *, w / SUM(w) OVER (PARTITION BY goal_id, counter_id, user_id, chain_id) AS nw FROM dw{s}),
m_dec{s} AS (
  SELECT goal_id, 'time_decay' AS attribution_type, d AS start_date, src AS source_code,
         SUM(nw) AS visits, SUM(nw * c) AS conversions, SUM(nw * r) AS revenue
  FROM dwt{s} GROUP BY goal_id, d, src),
m_ast{s} AS (
  SELECT goal_id, d AS start_date, src AS source_code, SUM(c) AS assisted_conversions,
         SUM(r) AS assisted_revenue
  FROM (SELECT DISTINCT goal_id, counter_id, user_id, chain_id, d, c, r, src
        FROM {src} WHERE c > 0 AND len > 1 AND jpos < len)
  GROUP BY goal_id, d, src),
m_lta{s} AS (
  SELECT l.*, COALESCE(a.assisted_conversions, 0.0) AS assisted_conversions,
         COALESCE(a.assisted_revenue, 0.0) AS assisted_revenue
  FROM m_last{s} l LEFT JOIN m_ast{s} a ON a.goal_id = l.goal_id AND a.start_date = l.start_date
       AND a.source_code = l.source_code),
m_all{s} AS (
  SELECT {res}, 0.0 AS assisted_conversions, 0.0 AS assisted_revenue FROM m_first{s}
  UNION ALL SELECT {res}, assisted_conversions, assisted_revenue FROM m_lta{s}
  UNION ALL SELECT {res}, 0.0, 0.0 FROM m_lsig{s}
  UNION ALL SELECT {res}, 0.0, 0.0 FROM m_lin{s}
  UNION ALL SELECT {res}, 0.0, 0.0 FROM m_dec{s}),
m_tr{s} AS (
  SELECT a.goal_id, a.d AS start_date, a.src AS prev_source_code, b.src AS next_source_code,
         CAST(COUNT(*) AS DOUBLE) AS transitions, SUM(a.c) AS converting_chains
  FROM {src} a JOIN {src} b ON a.goal_id = b.goal_id AND a.counter_id = b.counter_id
       AND a.user_id = b.user_id AND a.chain_id = b.chain_id AND b.jpos = a.jpos + 1
  GROUP BY a.goal_id, a.d, a.src, b.src)"""


def read_dictionary_rows(path: str) -> list[tuple[int, str]]:
    """Plain-Python reading of a lookup file with the same rules as the Spark loader."""
    rows: list[tuple[int, str]] = []
    if not os.path.exists(path):
        return rows
    with open(path, encoding="utf-8") as fh:
        for line in fh.read().splitlines():
            line = line.strip()
            if not line or line.startswith("#") or "," not in line:
                continue
            head, name = line.split(",", 1)
            try:
                ident = int(head.strip())
            except ValueError:
                continue
            if name.strip():
                rows.append((ident, name.strip()))
    return rows


def dict_cte(directory: str = BUNDLED_DIR) -> str:
    values = []
    for root, fn in DICTIONARY_FILES.items():
        seen = {}
        for ident, name in read_dictionary_rows(os.path.join(directory, fn)):
            seen[ident] = min(seen.get(ident, name), name)
        values += [f"({root}, {i}, {_q(n)})" for i, n in seen.items()]
    return "dct AS (SELECT * FROM (VALUES " + ", ".join(values) + ") AS v(root_id, id, name))"


def name_sql(code: str, root: str, sub: str, looked: str) -> str:
    whens = []
    for r in sorted(set(ROOT_LABELS) | set(ROOT_PREFIXES)):
        if r in ROOT_LABELS:
            whens.append(f"WHEN {root} = {r} THEN {_q(ROOT_LABELS[r])}")
        else:
            whens.append(f"WHEN {root} = {r} THEN {_q(ROOT_PREFIXES[r])} || COALESCE(NULLIF({looked}, ''), "
                         f"{_q(MISSING_NAME_PREFIX)} || CAST({sub} AS VARCHAR))")
    return "CASE " + " ".join(whens) + f" ELSE {code} END"


def named_ctes(s: str = "") -> str:
    def side(code: str, alias: str) -> tuple[str, str, str]:
        root = f"TRY_CAST(split_part({code}, '_', 1) AS SMALLINT)"
        sub = f"COALESCE(TRY_CAST(split_part({code}, '_', 2) AS INTEGER), 0)"
        return root, sub, alias

    r, sb, _ = side("x.source_code", "d")
    pr, psb, _ = side("x.prev_source_code", "pd")
    nr, nsb, _ = side("x.next_source_code", "nd")
    return f"""
{dict_cte()},
nres{s} AS (
  SELECT x.*, {name_sql('x.source_code', r, sb, 'd.name')} AS source_name
  FROM m_all{s} x LEFT JOIN dct d ON d.root_id = {r} AND d.id = {sb}),
ntr{s} AS (
  SELECT x.*, {name_sql('x.prev_source_code', pr, psb, 'pd.name')} AS prev_source_name,
         {name_sql('x.next_source_code', nr, nsb, 'nd.name')} AS next_source_name
  FROM m_tr{s} x LEFT JOIN dct pd ON pd.root_id = {pr} AND pd.id = {psb}
       LEFT JOIN dct nd ON nd.root_id = {nr} AND nd.id = {nsb}),
along{s} AS (
  SELECT goal_id, start_date, source_code, source_name, {_q(METRIC_DIRECT)} AS metric_type,
         conversions AS value, revenue AS value_money FROM nres{s} WHERE attribution_type = 'last_touch'
  UNION ALL
  SELECT goal_id, start_date, source_code, source_name, {_q(METRIC_ASSISTED)}, assisted_conversions,
         assisted_revenue FROM nres{s} WHERE attribution_type = 'last_touch')"""


def model_name_sql(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {_q(k)} THEN {_q(v)}" for k, v in MODEL_LABELS.items()) + " END"


def lookback_ctes(days: int = 90, half_life: float = 7.0) -> str:
    span = int(days) * 86400
    h = float(half_life)
    return f"""
lb AS (
  SELECT i.goal_id, i.counter_id, i.user_id, i.visit_id AS conv_visit_id, j.visit_id, j.source_code,
         ROW_NUMBER() OVER (PARTITION BY i.goal_id, i.counter_id, i.user_id, i.visit_id
                            ORDER BY j.ts, j.visit_id) AS position,
         COUNT(*) OVER (PARTITION BY i.goal_id, i.counter_id, i.user_id, i.visit_id) AS chain_length,
         (i.ts - j.ts) / 86400.0 AS days_before_conv,
         CASE WHEN i.visit_id = j.visit_id THEN 1 ELSE 0 END AS is_converting
  FROM p i JOIN p j ON i.goal_id = j.goal_id AND i.counter_id = j.counter_id AND i.user_id = j.user_id
       AND j.ts BETWEEN i.ts - {span} AND i.ts
  WHERE i.conversions > 0),
lbw AS (
  SELECT *, power(2.0, -days_before_conv / {h}) AS w,
         SUM(power(2.0, -days_before_conv / {h})) OVER (PARTITION BY goal_id, counter_id, user_id, conv_visit_id) AS tw
  FROM lb),
lbsig AS (
  SELECT goal_id, counter_id, user_id, conv_visit_id,
         COALESCE(MAX(CASE WHEN {_sig('source_code')} THEN position END), MAX(position)) AS sp
  FROM lb GROUP BY goal_id, counter_id, user_id, conv_visit_id)"""
