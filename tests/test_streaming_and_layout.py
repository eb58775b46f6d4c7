import os
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from conftest import SF
from pathcredit.schema import VISIT_KEY, raw_schema
from pathcredit.sources.visits import raw_visits, scan_visits, write_raw, write_raw_table
from pathcredit.streaming.ingest import ingest_raw
from pathcredit.operators.prepare import prepare_visits


def test_write_raw_partitions_by_monday(spark, tmp_path):
    raw = raw_visits(spark, SF)
    path = str(tmp_path / "raw")
    write_raw(raw, path, mode="overwrite")
    back = spark.read.parquet(path)
    assert back.count() == raw.count()
    weeks = {r.week for r in back.select("week").distinct().collect()}
    assert all(w.weekday() == 0 for w in weeks)
    assert back.where(F.col("week") != F.trunc("start_date", "week")).count() == 0


def test_streaming_ingest_takes_each_file_once(spark, tmp_path):
    landing, store, ckpt = (str(tmp_path / d) for d in ("landing", "store", "ckpt"))
    raw = raw_visits(spark, SF)
    raw.where(F.col("visit_id") < 500).write.parquet(os.path.join(landing, "day1"))
    ingest_raw(spark, landing + "/*", store, ckpt).awaitTermination()
    first = spark.read.parquet(store).count()
    raw.where(F.col("visit_id") >= 500).write.parquet(os.path.join(landing, "day2"))
    ingest_raw(spark, landing + "/*", store, ckpt).awaitTermination()
    assert first == raw.where(F.col("visit_id") < 500).count()
    assert spark.read.parquet(store).count() == raw.count()


def test_streaming_ingest_lands_unsigned_ids(spark, tmp_path):
    landing, store, ckpt = (str(tmp_path / d) for d in ("landing", "store", "ckpt"))
    high = (F.col("visit_id").cast("decimal(20,0)") + F.lit(Decimal(2 ** 63))).cast("decimal(20,0)")
    raw = raw_visits(spark, SF).where("visit_id < 50").withColumns({"visit_id": high, "user_id": high})
    raw.select(*[F.col(f.name).cast(f.dataType) for f in raw_schema(True).fields]).write.parquet(os.path.join(landing, "day1"))
    ingest_raw(spark, landing + "/*", store, ckpt, unsigned=True).awaitTermination()
    got = spark.read.parquet(store)
    assert got.schema["visit_id"].dataType.simpleString() == "decimal(20,0)"
    assert {r.visit_id for r in got.collect()} == {r.visit_id for r in raw.collect()}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    raw, store = raw_visits(spark, SF), str(tmp_path / "store")
    for part in (raw, raw, raw.where("visit_id < 100")):
        write_raw(part, f"{store}/batch=3", mode="overwrite")
    write_raw(raw, f"{store}/batch=4", mode="overwrite")
    assert spark.read.parquet(store).count() == raw.count() + raw.where("visit_id < 100").count()


def test_a_heavy_visitors_week_is_spread(spark, tmp_path):
    raw = raw_visits(spark, SF)
    bot = raw.where("visit_id % 3 = 0").withColumn("user_id", F.lit(5).cast("long"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the test's partitions are tiny
    try:
        write_raw(bot, str(tmp_path / "raw"), mode="overwrite")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(str(tmp_path / "raw")).select(F.input_file_name().alias("f")).distinct().count()
    assert files > bot.select(F.trunc("start_date", "week")).distinct().count()


def test_a_bucketed_store_is_collapsed_without_a_shuffle(spark, tmp_path):
    raw, name = raw_visits(spark, SF), "raw_store_under_test"
    bot = raw.withColumn("user_id", F.when(F.col("visit_id") % 3 == 0, F.lit(5)).otherwise(F.col("user_id")).cast("long"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_raw_table(bot.where("visit_version = 1"), name, str(tmp_path / "raw"), 8)
    write_raw_table(bot.where("visit_version > 1"), name, str(tmp_path / "raw"), 8)  # later deliveries of the same visits
    p = prepare_visits(scan_visits(spark, name, 1), 1, (99, 42))
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    want = prepare_visits(bot, 1, (99, 42))
    assert p.exceptAll(want).count() == 0 and p.count() == want.count()
    buckets = (scan_visits(spark, name).where("user_id = 5").groupBy(F.pmod(F.hash(*VISIT_KEY), F.lit(8))).count().collect())
    assert len(buckets) == 8 and max(r["count"] for r in buckets) < 2 * min(r["count"] for r in buckets)
    spark.sql(f"DROP TABLE {name}")


def test_touch_table_does_not_reshuffle_visits(spark):
    """Sessions are written bucketed by (chunk, visitor); the touch table's windows and
    summary join read them in place, so only the small per-(chunk, visitor) summary moves."""
    from pathcredit.config import ensure_utc, materialize
    from pathcredit.operators import models as M
    from pathcredit.operators.scan import layout
    from pathcredit.operators.sessions import sessionize
    ensure_utc(spark)
    p = prepare_visits(raw_visits(spark, SF), 1, 99)
    s = materialize(sessionize(p, timeout=116956), layout())
    plan = M.touch_table(s, checkpoint=False)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "Bucketed: true" in plan
    assert exchanges and all("_chunk" not in line for line in exchanges)


@pytest.mark.parametrize("n", [1, 3, 8, 16, 200])
def test_chunk_labels_hash_to_their_own_bucket(spark, n):
    """Range task p writes its rows with label L(p); bucketBy(n) must put them in bucket p."""
    from pathcredit.operators.scan import CHUNK, chunk_labels
    labels = chunk_labels(spark, n)
    rows = labels.select("_part", F.pmod(F.hash(CHUNK), F.lit(n)).alias("_bucket")).collect()
    assert sorted(r._part for r in rows) == list(range(n))
    assert all(r._part == r._bucket for r in rows)
