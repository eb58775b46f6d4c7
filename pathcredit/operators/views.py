"""Named views: results and transitions with channel names, direct vs assisted long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.constants import METRIC_ASSISTED, METRIC_DIRECT
from pathcredit.functions.codes import root_id, sub_id
from pathcredit.functions.names import channel_name


def with_channel_name(df: DataFrame, code: str, name: str, dicts: DataFrame) -> DataFrame:
    """Add ``name`` for channel code column ``code`` with one left join to the merged lookup.

    ``dicts`` is joined as given; Spark broadcasts it when its bytes are few enough.
    """
    r, s, n = f"_{name}_root", f"_{name}_sub", f"_{name}_dict"
    d = dicts.select(F.col("root_id").alias(r), F.col("id").alias(s), F.col("name").alias(n))
    out = df.withColumn(r, root_id(code)).withColumn(s, sub_id(code))
    out = out.join(d, [r, s], "left")
    return out.withColumn(name, channel_name(F.col(code), F.col(r), F.col(s), F.col(n))).drop(r, s, n)


def v_attribution_results(results: DataFrame, dicts: DataFrame) -> DataFrame:
    return with_channel_name(results, "source_code", "source_name", dicts)


def v_source_transitions(trans: DataFrame, dicts: DataFrame) -> DataFrame:
    out = with_channel_name(trans, "prev_source_code", "prev_source_name", dicts)
    return with_channel_name(out, "next_source_code", "next_source_name", dicts)


def v_assisted_long(named_results: DataFrame) -> DataFrame:
    """Last-touch rows as two rows each: direct and assisted conversions/revenue."""
    lt = named_results.where(F.col("attribution_type") == "last_touch")
    keys = ["goal_id", "start_date", "source_code", "source_name"]
    direct = lt.select(*keys, F.lit(METRIC_DIRECT).alias("metric_type"),
                       F.col("conversions").alias("value"), F.col("revenue").alias("value_money"))
    assist = lt.select(*keys, F.lit(METRIC_ASSISTED).alias("metric_type"),
                       F.col("assisted_conversions").alias("value"), F.col("assisted_revenue").alias("value_money"))
    return direct.unionByName(assist)
