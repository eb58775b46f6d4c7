"""Verification queries run after the job: counts, per-model summary, invariants, top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.constants import MODEL_LABELS, TOP_GOALS, TOP_LAST_TOUCH


def table_counts(spark, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table; ``empty`` flags the ones a warning is due for."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out.withColumn("empty", (F.col("rows") == 0).cast("int"))


def model_metrics() -> list[Column]:
    """Aggregates of the results table, per model, for a write that observes them."""
    of = [(m, F.col("attribution_type") == m) for m in MODEL_LABELS]
    return [F.coalesce(F.sum(F.when(is_model, F.lit(1.0) if c == "rows" else F.col(c))), F.lit(0.0)).alias(f"{c}:{m}")
            for m, is_model in of for c in ("rows", "visits", "conversions", "revenue")]


def observed_checks(spark: SparkSession, counts: dict[str, int], sums: dict[str, float], conversions: int) -> DataFrame:
    """(check_name, subject, value) from what the daily job's writes observed: rows of each table, rows and sums of
    each model, and the two invariants (1: holds): models have equal visit totals and the prepared conversions."""
    rows = [("table_rows", name, float(n)) for name, n in counts.items()]
    models = [m for m in MODEL_LABELS if sums[f"rows:{m}"]]
    rows += [(c, m, round(sums[f"{c}:{m}"], 2)) for m in models for c in ("rows", "visits", "conversions", "revenue")]
    equal = len({round(sums[f"visits:{m}"], 2) for m in models}) <= 1
    rows += [("visit_invariant", "all", float(equal))]
    rows += [("conversion_invariant", m, float(abs(sums[f"conversions:{m}"] - (conversions or 0)) < 1e-6)) for m in models]
    return spark.createDataFrame(rows, "check_name string, subject string, value double")


def model_summary(results: DataFrame) -> DataFrame:
    return (results.groupBy("attribution_type")
            .agg(F.count("*").alias("rows"), F.round(F.sum("visits"), 2).alias("visits"),
                 F.round(F.sum("conversions"), 2).alias("conv"), F.round(F.sum("revenue"), 2).alias("revenue"))
            .orderBy("attribution_type"))


def model_count(results: DataFrame) -> DataFrame:
    return results.agg(F.count_distinct("attribution_type").alias("n_models"))


def visit_invariant(results: DataFrame) -> DataFrame:
    """Distinct per-model visit totals rounded to 2 decimals: 1 when every model credits each chain once."""
    per_model = results.groupBy("attribution_type").agg(F.sum("visits").alias("s"))
    return per_model.agg(F.count_distinct(F.round("s", 2)).alias("distinct_visit_totals"))


def conversion_invariant(results: DataFrame, touches: DataFrame) -> DataFrame:
    """Per model: credited conversions against the conversions of all chains."""
    expected = touches.select(F.sum("c")).scalar()
    got = results.groupBy("attribution_type").agg(F.sum("conversions").alias("conversions"))
    return got.withColumn("expected", expected.cast("double")).withColumn(
        "holds", (F.abs(F.col("conversions") - F.col("expected")) < 1e-6).cast("int"))


def top5_last_touch(results: DataFrame, n: int = TOP_LAST_TOUCH) -> DataFrame:
    """Top last-touch channels by conversions, or by visits when there are no conversions."""
    lt = results.where(F.col("attribution_type") == "last_touch").groupBy("source_code").agg(
        F.round(F.sum("conversions"), 2).alias("conv"), F.round(F.sum("visits"), 2).alias("visits"))
    any_conv = results.where(F.col("attribution_type") == "last_touch").select(
        (F.sum("conversions") > 0).alias("x")).scalar()
    key = F.when(any_conv, F.col("conv")).otherwise(F.col("visits"))
    return lt.orderBy(key.desc(), F.col("source_code")).limit(n)


def goal_frequency(raw: DataFrame, n: int = TOP_GOALS) -> DataFrame:
    """Most frequent goal ids over all raw deliveries."""
    return (raw.select(F.explode("goals.id").alias("goal_id")).groupBy("goal_id")
            .agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "goal_id").limit(n))
