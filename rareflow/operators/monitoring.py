"""Metrics against baselines and rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.bands import degradation_status
from rareflow.operators.quantiles import exact_quantiles

# Metric, bound kind, bound.
FLOOR_RULES = (
    ("precision", "min", 0.80),
    ("recall", "min", 0.75),
    ("latency_p95_ms", "max", 200.0),
    ("error_rate", "max", 0.01),
)


def baseline_frame(spark: SparkSession, baseline: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame(list(baseline.items()), "metric string, baseline double")


def compare_with_baseline(
    current: DataFrame, baseline: Mapping[str, float], warning: float = 5.0, critical: float = 10.0
) -> DataFrame:
    """``current`` holds (metric, value); metrics without a baseline drop out."""
    pct = (F.col("baseline") - F.col("current")) / F.col("baseline") * 100
    return (
        current.withColumnRenamed("value", "current")
        .join(F.broadcast(baseline_frame(current.sparkSession, baseline)), "metric")
        .select("metric", "baseline", "current", pct.alias("degradation_pct"))
        .withColumn("status", degradation_status("degradation_pct", warning, critical))
    )


def without_baseline(current: DataFrame, baseline: Mapping[str, float]) -> DataFrame:
    return current.join(
        F.broadcast(baseline_frame(current.sparkSession, baseline)), "metric", "left_anti"
    )


def alerts(comparison: DataFrame) -> DataFrame:
    return comparison.where(F.col("status") != "OK").select(
        "metric", "status", F.concat_ws(": ", "metric", "status").alias("alert")
    )


def run_summary(report: DataFrame, comparison: DataFrame) -> DataFrame:
    def metric(name, field):
        return F.max(F.when(F.col("metric") == name, F.col(field)))

    perf = comparison.agg(
        metric("pr_auc", "current").alias("current_pr_auc"),
        metric("pr_auc", "baseline").alias("baseline_pr_auc"),
        metric("f1_score", "current").alias("current_f1"),
        metric("f1_score", "baseline").alias("baseline_f1"),
    ).first()
    out = report.agg(
        F.count(F.lit(1)).alias("features_monitored"),
        F.count_if(F.col("drift_severity_psi") != "No drift").alias("features_with_drift"),
        F.count_if(F.col("drift_severity_psi") == "Major drift").alias("major_drift_features"),
        F.max_by("feature", "psi").alias("top_drifted_feature"),
    )
    return out.withColumns({k: F.lit(v).cast("double") for k, v in perf.asDict().items()})


def service_metrics(df: DataFrame, latency: str, failed: Column) -> DataFrame:
    """95th latency percentile and error share as (metric, value)."""
    p95 = exact_quantiles(df, {"latency": F.col(latency)}, [0.95])["latency"][0]
    return df.agg(
        F.avg(F.when(failed, 1.0).otherwise(0.0)).alias("error_rate"),
        F.max(F.lit(p95)).alias("latency_p95_ms"),
    ).unpivot([], ["error_rate", "latency_p95_ms"], "metric", "value")


def floor_alerts(observed: DataFrame, rules=FLOOR_RULES) -> DataFrame:
    table = observed.sparkSession.createDataFrame(list(rules), "metric string, kind string, bound double")
    broken = F.when(F.col("kind") == "min", F.col("value") < F.col("bound")).otherwise(
        F.col("value") > F.col("bound")
    )
    return observed.join(F.broadcast(table), "metric").select(
        "metric", "value", "bound", broken.alias("alert")
    )
