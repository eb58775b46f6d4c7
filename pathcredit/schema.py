"""Schemas of the raw visit table and of the pipeline outputs."""

from pyspark.sql import types as T

TRAFFIC_SOURCE = T.StructType([
    T.StructField("model", T.IntegerType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("search_engine_id", T.IntegerType()),
    T.StructField("search_engine_root_id", T.IntegerType()),
    T.StructField("adv_engine_id", T.IntegerType()),
    T.StructField("social_network_id", T.IntegerType()),
    T.StructField("recommendation_system_id", T.IntegerType()),
    T.StructField("messenger_id", T.IntegerType()),
    T.StructField("click_banner_id", T.LongType()),
    T.StructField("click_target_type", T.IntegerType()),
])

GOAL_HIT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("serial", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.IntegerType()),
])

PURCHASE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("revenue", T.DoubleType()),
])

RAW_VISITS = T.StructType([
    T.StructField("counter_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("visit_id", T.LongType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("utc_start_time", T.TimestampType()),
    T.StructField("duration", T.LongType()),
    T.StructField("visit_version", T.LongType()),
    T.StructField("sign", T.ByteType()),
    T.StructField("traffic_source", T.ArrayType(TRAFFIC_SOURCE)),
    T.StructField("goals", T.ArrayType(GOAL_HIT)),
    T.StructField("purchases", T.ArrayType(PURCHASE)),
])

# Columns of the primary traffic source that feed the channel code.
TOUCH_FIELDS = (
    "id", "search_engine_root_id", "adv_engine_id", "social_network_id",
    "recommendation_system_id", "messenger_id", "click_banner_id", "click_target_type",
)

# Flat (parallel-array) column names as delivered by the visit export.
PARALLEL_TRAFFIC = {
    "model": "TrafficSource.Model",
    "id": "TrafficSource.ID",
    "start_time": "TrafficSource.StartTime",
    "search_engine_id": "TrafficSource.SearchEngineID",
    "search_engine_root_id": "TrafficSource.SearchEngineRootID",
    "adv_engine_id": "TrafficSource.AdvEngineID",
    "social_network_id": "TrafficSource.SocialSourceNetworkID",
    "recommendation_system_id": "TrafficSource.RecommendationSystemID",
    "messenger_id": "TrafficSource.MessengerID",
    "click_banner_id": "TrafficSource.ClickBannerID",
    "click_target_type": "TrafficSource.ClickTargetType",
}
PARALLEL_GOALS = {
    "id": "Goals.ID",
    "serial": "Goals.Serial",
    "event_time": "Goals.EventTime",
    "price": "Goals.Price",
    "currency": "Goals.Currency",
}
PARALLEL_PURCHASES = {"id": "EPurchase.ID", "revenue": "EPurchase.Revenue"}
PARALLEL_SCALARS = {
    "CounterID": "counter_id",
    "CounterUserIDHash": "user_id",
    "VisitID": "visit_id",
    "StartDate": "start_date",
    "UTCStartTime": "utc_start_time",
    "Duration": "duration",
    "VisitVersion": "visit_version",
    "Sign": "sign",
}

# Ids that the export delivers as unsigned 64-bit numbers.
UNSIGNED_IDS = ("user_id", "visit_id")

#: What tells visits apart; deliveries of one visit share it.
VISIT_KEY = ("counter_id", "user_id", "visit_id", "start_date")


def raw_schema(unsigned: bool = False) -> T.StructType:
    """The raw deliveries' schema; with ``unsigned``, ids that may pass 2**63 - 1 are decimals."""
    if not unsigned:
        return RAW_VISITS
    wide = T.DecimalType(20, 0)
    touch = T.StructType([T.StructField(f.name, wide) if f.name == "click_banner_id" else f for f in TRAFFIC_SOURCE.fields])
    kinds = {**dict.fromkeys(UNSIGNED_IDS, wide), "traffic_source": T.ArrayType(touch)}
    return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in RAW_VISITS.fields])
