import time

import fixtures as FX
from conftest import SF
from pathcredit import config
from pathcredit.plans.attribution import AttributionRun, forget_runs, run_for


def test_chunks_and_partitions_grow_with_the_input(spark, monkeypatch):
    """No task's share grows: sf0.001 has 1,000 events, here 50 a partition."""
    monkeypatch.setattr(config, "ROWS_A_PARTITION", 50)
    forget_runs()
    run = run_for(spark, SF)
    assert run.touches.select("_chunk").distinct().count() > 12
    assert spark.conf.get("spark.sql.shuffle.partitions") == "20"
    assert config._bytes(spark, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 8 << 20
    rows = {tuple(r) for r in run.results.drop("calculated_at").select("attribution_type", "start_date", "source_code").collect()}
    monkeypatch.undo()
    forget_runs()
    again = run_for(spark, SF)
    assert again.touches.select("_chunk").distinct().count() <= 8  # the session's own number again
    assert rows == {tuple(r) for r in again.results.select("attribution_type", "start_date", "source_code").collect()}
    forget_runs()


def test_partitions_set_by_the_user_hold(spark):
    config.ensure_partitions(spark, 100 * config.ROWS_A_PARTITION)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    assert config.ensure_partitions(spark, 0) == 12 and config.ensure_partitions(spark, 14 * config.ROWS_A_PARTITION) == 14
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert config.ensure_partitions(spark, 0) == 8


def test_a_second_run_over_the_same_touches(spark):
    """Another half-life of one of the goals gives what a run of its own gives, with no visit laid out again."""
    raw = FX.raw(spark, [v for visits in FX.HISTORIES.values() for v in visits])
    first = AttributionRun(spark, raw, FX.COUNTER, (FX.GOAL, 42), timeout=FX.SESSION_GAP)
    again, own = first.again(42, 2.0), AttributionRun(spark, raw, FX.COUNTER, 42, 2.0, timeout=FX.SESSION_GAP)

    def rows(run):
        return sorted(tuple(round(x, 8) if isinstance(x, float) else x for x in r) for r in run.results.drop("calculated_at").collect())

    assert rows(again) == rows(own) and rows(again)
    assert "_sessionized" in again.__dict__ and "_visits" not in again.__dict__


def test_written_tables_free_their_shuffles(spark):
    """Shuffle files of a write go with it; else they stay until the driver collects its garbage."""
    def files():
        found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().endswith(".data")}

    before, own = files(), spark.conf.get(config._FREE)
    wide = spark.range(20_000).repartition(7, "id")
    assert config.materialize(wide).count() == 20_000
    assert config.materialize(wide, ["id"], 5).count() == 20_000
    assert spark.conf.get(config._FREE) == own
    for _ in range(50):
        left = {f for f in files() - before if f.startswith("shuffle_")}
        if len(left) <= 16:  # those of the counts
            break
        time.sleep(0.1)
    assert wide.count() == 20_000 and len(left) <= 16
