"""The whole job for one counter: raw deliveries → results, transitions and named views.

Each stage is a lazy DataFrame; the two tables that many outputs reuse (the
sessionized visits and the touch table) are written once under the shared
checkpoint folder, which also cuts their lineage.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.config import ensure_partitions, ensure_utc, materialize
from pathcredit.constants import DEFAULT_HALF_LIFE_DAYS, DEFAULT_LOOKBACK_DAYS
from pathcredit.operators import chains as C
from pathcredit.operators import lookback as L
from pathcredit.operators import models as M
from pathcredit.operators import views as V
from pathcredit.operators.prepare import live_visits, per_goal
from pathcredit.operators.scan import VISITOR, rows_of_spanning
from pathcredit.operators.sessions import sessionize
from pathcredit.plans import checks as G
from pathcredit.sources import sinks
from pathcredit.sources.dictionaries import BUNDLED_DIR, load_dictionaries
from pathcredit.sources.visits import raw_visits, read_table, scan_visits


@dataclass
class AttributionRun:
    spark: SparkSession
    raw: DataFrame
    counter_id: int | None = 1
    goal_ids: int | Iterable[int] = 99
    half_life: float = DEFAULT_HALF_LIFE_DAYS
    timeout: int | None = None
    n_chunks: int | None = None
    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    dictionary_dir: str = BUNDLED_DIR
    calculated_at: Column | None = field(default=None)
    checks: DataFrame | None = field(default=None)  # set by a daily run

    @property
    def goals(self) -> tuple[int, ...]:
        return (self.goal_ids,) if isinstance(self.goal_ids, int) else tuple(self.goal_ids)

    @cached_property
    def live(self) -> DataFrame:
        return live_visits(self.raw, self.counter_id, self.goals)

    @cached_property
    def prepared(self) -> DataFrame:
        return per_goal(self.live)

    @cached_property
    def _visits(self) -> DataFrame:
        """Sessionize plan (writes the chunk table and learns the timeout when not given).

        Sessions do not depend on the goal: visits are laid out and cut into sessions
        once, and become a row per goal inside their chunks.
        """
        return sessionize(self.live, self.timeout, self.n_chunks, user=VISITOR)

    @cached_property
    def _sessionized(self) -> DataFrame:
        return per_goal(self._visits)

    @cached_property
    def touches(self) -> DataFrame:
        """Sessions plus running quantities, built in the chunk layout and written once."""
        return M.touch_table(self._sessionized, half_life=self.half_life, n_buckets=self.n_chunks,
                             across=per_goal(rows_of_spanning(self._visits)))

    def again(self, goal_ids: int | Iterable[int], half_life: float = DEFAULT_HALF_LIFE_DAYS) -> AttributionRun:
        """A run of some of these goals with another half-life, over the touches already written.

        Sessions depend on neither, so nothing is collapsed, laid out or cut into sessions again; the decay weights are
        the new half-life's.
        """
        run = replace(self, goal_ids=goal_ids, half_life=half_life, checks=None)
        if not set(run.goals) <= set(self.goals):
            raise ValueError(f"goals {run.goals} are not all among the run's {self.goals}")
        wanted = F.col("goal_id").isin(list(run.goals))
        for name in ("prepared", "_sessionized", "touches", "day_totals"):
            run.__dict__[name] = getattr(self, name).where(wanted)
        return run

    @cached_property
    def sessions(self) -> DataFrame:
        """Sessionized visits: the session columns of the written touch table (same layout)."""
        return self.touches.select(*self._sessionized.columns)

    @cached_property
    def day_totals(self) -> DataFrame:
        """Totals per (session, day), written once for the models and the transitions."""
        return materialize(M.session_day_totals(self.touches))

    @cached_property
    def results(self) -> DataFrame:
        """The results table (written once; views, marts and checks read it)."""
        return materialize(M.attribution_all(self.touches, self.half_life, self.calculated_at, self.day_totals))

    @cached_property
    def transitions(self) -> DataFrame:
        stamp = self.calculated_at if self.calculated_at is not None else F.current_timestamp()
        return materialize(M.transitions(self.touches, self.day_totals).withColumn("calculated_at", stamp))

    @cached_property
    def dictionaries(self) -> DataFrame:
        """The merged lookups; Spark broadcasts them when their bytes are few enough."""
        return load_dictionaries(self.spark, self.dictionary_dir)

    @cached_property
    def named_results(self) -> DataFrame:
        return V.v_attribution_results(self.results, self.dictionaries)

    @cached_property
    def named_transitions(self) -> DataFrame:
        return V.v_source_transitions(self.transitions, self.dictionaries)

    @cached_property
    def assisted_long(self) -> DataFrame:
        return V.v_assisted_long(self.named_results)

    def write(self, out: str) -> DataFrame:
        """The job's outputs under ``out``: prepared visits as a whole, the others per goal. Returns the checks.

        The checks are observed while the tables are written: no table is read again.
        """
        rows = F.count("*").alias("rows")
        seen = {PREPARED: sinks.write_prepared(self.prepared, f"{out}/{PREPARED}", rows, F.sum("conversions").alias("conversions"))}
        for name, table, metrics in ((COMBINED, C.chain_ends(self.sessions), [rows]),
                                     (TOUCHES, C.touch_blocks(self.sessions), [rows]),
                                     (RESULTS, self.results, [rows, *G.model_metrics()]),
                                     (TRANSITIONS, self.transitions, [rows])):
            seen[name] = sinks.replace_goals(table, f"{out}/{name}", self.goals, *metrics)
        return G.observed_checks(self.spark, {n: seen[n]["rows"] for n in (PREPARED, COMBINED, RESULTS, TRANSITIONS)},
                                 seen[RESULTS], seen[PREPARED]["conversions"])

    @cached_property
    def chains(self) -> DataFrame:
        return C.build_chains(self.sessions)

    @cached_property
    def lookback(self) -> DataFrame:
        return C.lookback_chains(self.touches, self.lookback_ends)

    @cached_property
    def lookback_ends(self) -> DataFrame:
        return materialize(L.chain_ends(self.touches, self.lookback_days))


PREPARED, COMBINED, TOUCHES, RESULTS, TRANSITIONS = (
    "visits_prepared", "visits_combined", "visits_combined_touches", "attribution_results", "source_transitions")


def read_combined(spark: SparkSession, out: str, where: Column | None = None) -> DataFrame:
    """The combined visits under ``out`` with their arrays, of the chains ``where`` selects."""
    ends = spark.read.parquet(f"{out}/{COMBINED}")
    return C.read_chains(ends if where is None else ends.where(where), spark.read.parquet(f"{out}/{TOUCHES}"))


def run_daily(spark: SparkSession, source: str | DataFrame, out: str, counter_id: int, goal_ids: int | Iterable[int],
              half_life: float = DEFAULT_HALF_LIFE_DAYS) -> AttributionRun:
    """The daily job: raw deliveries of a counter to the tables under ``out``.

    Prepared visits are refreshed as a whole; the goals' partitions of the
    combined visits, their touches, results and transitions are replaced, also by nothing; other goals
    stay. The run's ``checks`` hold the observed counts, sums and invariants.
    """
    ensure_utc(spark)
    goals = goal_ids if isinstance(goal_ids, int) else tuple(goal_ids)
    raw = scan_visits(spark, source, counter_id)
    ensure_partitions(spark, raw.count())
    run = AttributionRun(spark, raw, counter_id, goals, half_life)
    run.checks = run.write(out)
    return run


_RUNS: dict[tuple, AttributionRun] = {}
_KEPT_RUNS = 16


def run_for(spark: SparkSession, sf_dir: str, **params) -> AttributionRun:
    """Job over the visits derived from ``sf_dir``'s ``events``; one per session and parameters."""
    ensure_utc(spark)
    ensure_partitions(spark, read_table(spark, sf_dir, "events").count())
    key = (spark.sparkContext.applicationId, sf_dir, tuple(sorted(params.items())))
    run = _RUNS.get(key)
    if run is None:
        run = AttributionRun(spark, raw_visits(spark, sf_dir), **params)
        while len(_RUNS) >= _KEPT_RUNS:
            del _RUNS[next(iter(_RUNS))]  # the oldest
        _RUNS[key] = run
    return run


def forget_runs() -> None:
    _RUNS.clear()
