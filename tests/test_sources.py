from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from conftest import SF
from pathcredit.operators.prepare import collapse, prepare_visits
from pathcredit.sources import goals as GL
from pathcredit.sources.dictionaries import load_dictionaries, load_dictionary
from pathcredit.sources.visits import denormalise_nested, normalise_nested, raw_visits, scan_visits


def test_raw_and_live_counts_match_golden(spark):
    raw = raw_visits(spark, SF)
    assert raw.count() == 1290
    p = prepare_visits(raw, 1, 99)
    assert p.count() == 820
    row = p.agg(F.sum("conversions").alias("c"), F.sum("revenue").alias("r")).first()
    assert row.c == 199 and round(row.r, 2) == 10169.20


def test_scan_filters_counter(spark):
    raw = raw_visits(spark, SF)
    assert scan_visits(spark, raw, 2).where(F.col("counter_id") != 2).count() == 0


def test_collapse_keeps_latest_version_and_drops_cancelled(spark):
    raw = raw_visits(spark, SF)
    live = collapse(raw)
    ids = {r.visit_id: r.visit_version for r in live.select("visit_id", "visit_version").collect()}
    assert 17 not in ids            # cancelled (17 % 17 == 0)
    assert ids[10] == 2             # corrected
    assert ids[23] == 3             # re-delivered without cancel
    assert ids[1] == 1


def test_parallel_arrays_round_trip(spark):
    raw = raw_visits(spark, SF)
    back = normalise_nested(denormalise_nested(raw))
    assert [(f.name, f.dataType.simpleString()) for f in back.schema] == \
        [(f.name, f.dataType.simpleString()) for f in raw.schema]
    assert back.exceptAll(raw).count() == 0


def test_parallel_arrays_of_unequal_length_are_rejected(spark):
    flat = denormalise_nested(raw_visits(spark, SF)).limit(1)
    broken = flat.withColumn("Goals.ID", F.array(F.lit(1).cast("long"), F.lit(2).cast("long")))
    with pytest.raises(SparkRuntimeException, match="parallel arrays differ in length"):
        normalise_nested(broken).collect()


def test_dictionary_loader_edge_cases(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text("id,name_ru\n# comment\n\n 5 , a, b \nx,bad\n7,\nnocomma\n8,ok\n", encoding="utf-8")
    rows = {r.id: r.name for r in load_dictionary(spark, str(p)).collect()}
    assert rows == {5: "a, b", 8: "ok"}
    assert load_dictionary(spark, str(tmp_path / "missing.csv")).count() == 0


def test_bundled_dictionaries(spark):
    d = load_dictionaries(spark)
    counts = {r.root_id: r["count"] for r in d.groupBy("root_id").count().collect()}
    assert counts == {2: 8, 3: 25, 8: 15, 9: 3, 10: 4}


CATALOGUE = """{"goals": [
 {"id": 11, "name": "Seat booked", "type": "action"},
 {"id": 12, "name": "Brochure", "type": "file", "is_retargeting": 0, "steps": [{"id": 1}]},
 {"id": 13, "name": "Watched the tour", "type": "number", "is_retargeting": 0},
 {"id": 14, "name": "Left at checkout", "type": "action", "is_retargeting": 1},
 {"id": 15, "name": "\\tSEAT booked", "type": "chat", "is_retargeting": 0}]}"""


def test_goal_catalogue_filter_and_lookup(spark, tmp_path):
    p = tmp_path / "goals.json"
    p.write_text(CATALOGUE)
    cat = GL.read_goal_catalogue(spark, str(p))
    assert cat.count() == 5 and GL.usable_goals(cat, show_all=True).count() == 5
    assert {r.goal_id for r in GL.usable_goals(cat).collect()} == {11, 12, 15}
    assert GL.goal_by_name(cat, " brochure").first().goal_id == 12
    with pytest.raises(LookupError, match="no goal named"):
        GL.goal_by_name(cat, "Broch")


def test_an_ambiguous_goal_name_lists_every_id(spark):
    cat = spark.createDataFrame([(i, "Same", "action", 0) for i in range(30)],
                                "goal_id long, name string, type string, is_retargeting int")
    with pytest.raises(LookupError, match=", ".join(map(str, range(30)))):
        GL.goal_by_name(cat, "same")


def test_empty_and_missing_goal_arrays(spark, tmp_path):
    (tmp_path / "empty.json").write_text('{"goals": []}')
    assert GL.read_goal_catalogue(spark, str(tmp_path / "empty.json")).count() == 0
    (tmp_path / "other.json").write_text('{"targets": [{"id": 1}]}')
    with pytest.raises(ValueError):
        GL.read_goal_catalogue(spark, str(tmp_path / "other.json"))


def test_unsigned_ids_stay_whole(spark):
    flat = denormalise_nested(raw_visits(spark, SF)).limit(20)
    top = F.lit(Decimal(2 ** 64 - 1))
    wide = flat.withColumn("VisitID", top - F.col("VisitID").cast("decimal(20,0)"))
    wide = wide.withColumn("TrafficSource.ClickBannerID", F.transform("`TrafficSource.ClickBannerID`", lambda _: top))
    back = normalise_nested(wide)
    assert back.schema["visit_id"].dataType.simpleString() == "decimal(20,0)"
    assert back.schema["user_id"].dataType.simpleString() == "bigint"
    got = back.select("visit_id", F.col("traffic_source")[1]["click_banner_id"].alias("b")).collect()
    assert {r.b for r in got} == {Decimal(2 ** 64 - 1)} and min(r.visit_id for r in got) > 2 ** 63
