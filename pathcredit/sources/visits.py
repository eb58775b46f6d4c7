"""Raw visit sources: scan, parallel-array normalisation, weekly layout, and the
raw visits derived from the ``events`` test table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathcredit.schema import (
    PARALLEL_GOALS, PARALLEL_PURCHASES, PARALLEL_SCALARS, PARALLEL_TRAFFIC, RAW_VISITS, UNSIGNED_IDS, VISIT_KEY,
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan_visits(spark: SparkSession, source: str | DataFrame, counter_id: int | None = None) -> DataFrame:
    """Raw deliveries of one counter. ``source`` is a DataFrame, a parquet path or a table name.

    The counter predicate is a plain filter: Catalyst pushes it into the scan.
    """
    if isinstance(source, DataFrame):
        df = source
    elif "/" in source:
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    if counter_id is not None:
        df = df.where(F.col("counter_id") == F.lit(int(counter_id)))
    return df


def raw_visits_from_events(events: DataFrame) -> DataFrame:
    """Versioned, signed visit deliveries derived from ``events`` (rules in FIXTURES.md §3).

    Every event is one visit; some are cancelled, corrected or re-delivered, so the
    collapse logic downstream has real work to do.
    """
    eid = F.col("event_id")
    t = F.date_trunc("second", F.col("ts").cast("timestamp"))
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("int")

    def delivery(version: int, sign: int, kk: Column) -> Column:
        return F.struct(F.lit(version).cast("long").alias("visit_version"),
                        F.lit(sign).cast("byte").alias("sign"), kk.alias("kk"))

    first = delivery(1, 1, k)
    deliveries = (
        F.when(eid % 10 == 0, F.array(first, delivery(1, -1, k), delivery(2, 1, k + 1)))
        .when(eid % 17 == 0, F.array(first, delivery(1, -1, k)))
        .when(eid % 23 == 0, F.array(first, delivery(3, 1, k + 2)))
        .otherwise(F.array(first))
    )
    d = events.select(
        "event_id", "user_id", "event_type", "value", t.alias("t"),
        F.explode(deliveries).alias("d"),
    ).select("event_id", "user_id", "event_type", "value", "t", "d.*")

    kk = F.col("kk")

    def touch(model: int, tsid, root, adv, social, rec, msg, banner, target) -> Column:
        return F.struct(
            F.lit(model).alias("model"), tsid.cast("int").alias("id"), F.col("t").alias("start_time"),
            F.lit(0).alias("search_engine_id"), root.cast("int").alias("search_engine_root_id"),
            adv.cast("int").alias("adv_engine_id"), social.cast("int").alias("social_network_id"),
            rec.cast("int").alias("recommendation_system_id"), msg.cast("int").alias("messenger_id"),
            banner.cast("long").alias("click_banner_id"), target.cast("int").alias("click_target_type"),
        )

    zero = F.lit(0)
    secondary = touch(2, zero, zero, zero, zero, zero, zero, zero, zero)
    primary = touch(1, kk % 13 - 1, 25 + kk % 4, 1 + kk % 3, 1 + kk % 6, 2 + kk % 3, 1 + kk % 5,
                    (kk % 2) * (eid + 1), kk % 5)

    def hit(goal: int, price: Column, serial: int) -> Column:
        return F.struct(F.lit(goal).cast("long").alias("id"), F.lit(serial).cast("long").alias("serial"),
                        F.col("t").alias("event_time"), price.cast("double").alias("price"),
                        F.lit(643).alias("currency"))

    purchase_price = F.col("value") * F.lit(1e6)
    goals = (
        F.when((F.col("event_type") == "purchase") & (kk % 7 == 0),
               F.array(hit(99, purchase_price, 1), hit(99, purchase_price, 2)))
        .when(F.col("event_type") == "purchase", F.array(hit(99, purchase_price, 1)))
        .when(F.col("event_type") == "signup", F.array(hit(42, F.lit(0.0), 1)))
    )
    out = d.select(
        F.when(F.col("user_id") % 10 == 0, 2).otherwise(1).cast("long").alias("counter_id"),
        F.col("user_id").cast("long").alias("user_id"),
        eid.cast("long").alias("visit_id"),
        F.to_date("t").alias("start_date"),
        F.col("t").alias("utc_start_time"),
        (kk * 10).cast("long").alias("duration"),
        "visit_version", "sign",
        F.array(secondary, primary).alias("traffic_source"),
        F.coalesce(goals, F.array().cast(RAW_VISITS["goals"].dataType)).alias("goals"),
        F.array().cast(RAW_VISITS["purchases"].dataType).alias("purchases"),
    )
    return out


def raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_visits_from_events(read_table(spark, sf_dir, "events"))


def _field(name: str):
    return lambda x: x[name]


def denormalise_nested(df: DataFrame) -> DataFrame:
    """Inverse of :func:`normalise_nested`: arrays of structs → export-style parallel arrays."""
    cols = [F.col(ours).alias(theirs) for theirs, ours in PARALLEL_SCALARS.items()]
    for arr, mapping in (("traffic_source", PARALLEL_TRAFFIC), ("goals", PARALLEL_GOALS),
                         ("purchases", PARALLEL_PURCHASES)):
        cols += [F.transform(arr, _field(f)).alias(flat) for f, flat in mapping.items()]
    return df.select(*cols)


def normalise_nested(df: DataFrame) -> DataFrame:
    """Export-style parallel arrays (dotted names) → ``array<struct>`` columns.

    Rows whose parallel arrays differ in length are rejected with an error, as
    the export guarantees equal lengths. Visitor, visit and banner ids are
    unsigned 64-bit numbers: where the source delivers them as such (Spark reads
    them as ``decimal(20,0)``), they stay decimals, else they are longs.
    """
    def id_type(kind: T.DataType) -> T.DataType:
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        return T.DecimalType(20, 0) if isinstance(kind, T.DecimalType) else T.LongType()

    banner = id_type(df.schema[PARALLEL_TRAFFIC["click_banner_id"]].dataType)
    traffic = T.ArrayType(T.StructType([
        T.StructField(f.name, banner) if f.name == "click_banner_id" else f
        for f in RAW_VISITS["traffic_source"].dataType.elementType.fields]))
    def zipped(mapping: dict[str, str], struct_type) -> Column:
        arrays = [F.col(f"`{flat}`") for flat in mapping.values()]
        sizes = [F.size(a) for a in arrays]
        same = F.lit(True)
        for s in sizes[1:]:
            same = same & (s == sizes[0])
        z = F.arrays_zip(*[a.alias(f) for f, a in zip(mapping.keys(), arrays)])
        checked = F.when(same, z).otherwise(F.raise_error(F.lit("parallel arrays differ in length")))
        return checked.cast(struct_type)

    scalars = [F.col(f"`{theirs}`").cast(
        id_type(df.schema[theirs].dataType) if ours in UNSIGNED_IDS else RAW_VISITS[ours].dataType).alias(ours)
        for theirs, ours in PARALLEL_SCALARS.items()]
    return df.select(
        *scalars,
        zipped(PARALLEL_TRAFFIC, traffic).alias("traffic_source"),
        zipped(PARALLEL_GOALS, RAW_VISITS["goals"].dataType).alias("goals"),
        zipped(PARALLEL_PURCHASES, RAW_VISITS["purchases"].dataType).alias("purchases"),
    )


def with_week(df: DataFrame) -> DataFrame:
    """Monday of the visit's start date (the raw table's partition key)."""
    return df.withColumn("week", F.trunc("start_date", "week"))


def write_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    """Weekly-partitioned raw store, sorted like the source's key inside its files.

    Rows are dealt by ranges that go down to the visit, so a visitor with a large
    share of a week's visits is spread over several tasks and files. All weeks of
    ``path`` are replaced when ``mode`` is overwrite.
    """
    (with_week(df)
     .repartitionByRange("week", "counter_id", "user_id", "visit_id")
     .sortWithinPartitions("week", "counter_id", "start_date", "user_id", "visit_id")
     .write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("week").parquet(path))


def write_raw_table(df: DataFrame, name: str, path: str, n_buckets: int, mode: str = "append") -> None:
    """Weekly raw store as a table whose weeks are cut into buckets by the visit's key.

    All deliveries of a visit lie in one bucket, so collapsing them needs no shuffle, and as the
    hash takes in the visit id, a visitor with a large share of all visits is spread
    over all buckets. Appending (new deliveries, also of old visits) keeps the layout.
    """
    (with_week(df).repartition(n_buckets, *VISIT_KEY)
     .write.mode(mode).format("parquet").partitionBy("week").bucketBy(n_buckets, *VISIT_KEY).option("path", path).saveAsTable(name))
