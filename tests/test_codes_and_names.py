import pytest
from pyspark.sql import functions as F

from pathcredit.functions.codes import is_significant, primary_touch, root_id, source_code, sub_id
from pathcredit.operators.views import with_channel_name
from pathcredit.schema import RAW_VISITS
from pathcredit.sources.dictionaries import load_dictionaries

CASES = [
    # (id, search root, adv, social, recommendation, messenger, banner, target) -> code
    ((2, 26, 0, 0, 0, 0, 0, 0), "2_26"),
    ((3, 0, 1, 0, 0, 0, 77, 4), "3_1_4"),
    ((3, 0, 1, 0, 0, 0, 0, 4), "3_1"),
    ((3, 0, 2, 0, 0, 0, 77, 4), "3_2"),
    ((8, 0, 0, 5, 0, 0, 0, 0), "8_5"),
    ((9, 0, 0, 0, 2, 0, 0, 0), "9_2"),
    ((10, 0, 0, 0, 0, 3, 0, 0), "10_3"),
    ((-1, 0, 0, 0, 0, 0, 0, 0), "-1"),
    ((0, 9, 9, 9, 9, 9, 9, 9), "0"),
    ((6, 0, 0, 0, 0, 0, 0, 0), "6"),
    ((11, 0, 0, 0, 0, 0, 0, 0), "11"),
]


def _touches(spark, fields, model=1):
    t = dict(zip(("id", "search_engine_root_id", "adv_engine_id", "social_network_id",
                  "recommendation_system_id", "messenger_id", "click_banner_id", "click_target_type"), fields))
    t.update(model=model, start_time=None, search_engine_id=0)
    ts_type = RAW_VISITS["traffic_source"].dataType
    return spark.createDataFrame([([t],)], f"traffic_source {ts_type.simpleString()}")


@pytest.mark.parametrize("fields,code", CASES)
def test_source_code(spark, fields, code):
    df = _touches(spark, fields)
    assert df.select(source_code(primary_touch("traffic_source")).alias("c")).first().c == code


def test_missing_primary_touch_is_direct(spark):
    df = _touches(spark, (2, 26, 0, 0, 0, 0, 0, 0), model=2)
    assert df.select(source_code(primary_touch("traffic_source")).alias("c")).first().c == "0"


def test_split_and_significance(spark):
    df = spark.createDataFrame([("2_621",), ("3_1_4",), ("6",), ("null",), ("-1",), ("7",)], "code string")
    rows = {r.code: (r.root, r.sub, r.sig) for r in df.select(
        "code", root_id("code").alias("root"), sub_id("code").alias("sub"),
        is_significant("code").alias("sig")).collect()}
    assert rows == {"2_621": (2, 621, True), "3_1_4": (3, 1, True), "6": (6, 0, False),
                    "null": (None, 0, False), "-1": (-1, 0, False), "7": (7, 0, True)}


def test_channel_names(spark):
    codes = ["2_26", "2_621", "3_1_4", "8_1", "10_2", "-1", "0", "11", "7", "12", "null"]
    df = spark.createDataFrame([(c,) for c in codes], "source_code string")
    named = {r.source_code: r.source_name for r in
             with_channel_name(df, "source_code", "source_name", load_dictionaries(spark)).collect()}
    assert named["2_26"] == "Поиск: Яндекс"
    assert named["2_621"] == "Поиск: код 621"
    assert named["3_1_4"] == "Реклама: Яндекс"
    assert named["8_1"] == "Соцсети: ВКонтакте"
    assert named["10_2"] == "Мессенджеры: Telegram"
    assert named["-1"] == "Внутренние переходы"
    assert named["0"] == "Прямые заходы"
    assert named["11"] == "QR-код"
    assert named["7"] == "Почтовые рассылки"
    assert named["12"] == "12"
    assert named["null"] == "null"
