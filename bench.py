"""Benchmark: the daily attribution job and its headline queries on one machine.

Prints one JSON line. ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
``BENCH_CPUS`` (default 8) select the data and local parallelism.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pathcredit.config import local_session  # noqa: E402
from pathcredit.plans import registry  # noqa: E402
from pathcredit.plans.attribution import forget_runs, run_for  # noqa: E402

HEADLINE = ["sessionize", "attribution_all", "source_transitions", "v_attribution_results",
            "v_source_transitions", "chain_steps", "lookback_chains", "top_sources", "model_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="pathcredit-bench")
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pathcredit-bench-"))

    # Warm-up: the same job and queries once on the smallest data, so JVM start, JIT and
    # code generation are not billed to the measured run.
    warm = "/root/testdata/sf0.001"
    run_for(spark, warm).touches
    for key in HEADLINE:
        registry.QUERIES[key](spark, warm).write.format("noop").mode("overwrite").save()
    forget_runs()

    times: dict[str, float] = {}
    t0 = time.time()
    run = run_for(spark, sf_dir)
    run.touches  # prepare, sessionize and the touch table, each written once
    times["job_prepare_sessions"] = round(time.time() - t0, 3)
    for key in HEADLINE:
        t = time.time()
        registry.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "attribution_job_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
