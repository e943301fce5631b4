"""Batch scoring outputs, prediction tables and feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.bands import confidence, risk_level
from rareflow.operators import evaluation as ev

PREDICTIONS = (
    "transaction_id string, features string, prediction_score double, prediction_label int, "
    "created_at timestamp_ntz, feedback_label int, feedback_at timestamp_ntz, "
    "model_version string, created_date date"
)
MODEL_METRICS = (
    "model_version string, metric_name string, metric_value double, dataset_type string, "
    "created_at timestamp"
)
DRIFT_REPORTS = (
    "feature_name string, drift_score double, drift_detected boolean, report_data string, "
    "created_at timestamp"
)


def with_bands(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return ev.binarize(df, threshold).withColumns(
        {
            "risk_score": F.col("score") * 100.0,
            "confidence": confidence("score"),
            "risk_level": risk_level("score"),
        }
    )


def batch_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("pred").cast("bigint").alias("flagged"),
        F.avg("pred").alias("flagged_rate"),
    )


def as_predictions(df: DataFrame) -> DataFrame:
    """Scored rows in the shape of the stored prediction table."""
    return df.select(
        F.col("txn_id").cast("string").alias("transaction_id"),
        F.to_json(F.struct("Time", "Amount")).alias("features"),
        F.col("score").alias("prediction_score"),
        F.col("pred").alias("prediction_label"),
        F.col("ts").alias("created_at"),
        F.lit(None).cast("int").alias("feedback_label"),
        F.lit(None).cast("timestamp_ntz").alias("feedback_at"),
        "model_version",
        F.to_date("ts").alias("created_date"),
    )


def outcome_counts(predictions: DataFrame) -> DataFrame:
    """Predictions and rate per second by model version and outcome."""
    span = F.expr("timestampdiff(MICROSECOND, min(created_at), max(created_at)) / 1000000D")
    spans = predictions.groupBy("model_version").agg(span.alias("_span"))
    counts = predictions.groupBy("model_version", "prediction_label").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(spans, "model_version").select(
        "model_version", "prediction_label", "n", F.try_divide("n", "_span").alias("per_second")
    )


def latest_feedback(feedback: DataFrame) -> DataFrame:
    """The newest label of every transaction; copies fold on the map side."""
    return feedback.groupBy("transaction_id").agg(
        F.max_by("feedback_label", "feedback_at").alias("feedback_label"),
        F.max("feedback_at").alias("feedback_at"),
    )


def attach_feedback(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    return predictions.drop("feedback_label", "feedback_at").join(
        latest_feedback(feedback), "transaction_id", "left"
    )


def feedback_metrics(attached: DataFrame) -> DataFrame:
    labelled = attached.where(F.col("feedback_label").isNotNull()).select(
        "model_version",
        F.col("feedback_label").alias("label"),
        F.col("prediction_label").alias("pred"),
    )
    m = ev.basic_metrics(ev.confusion(labelled, ["model_version"]))
    return m.select("model_version", "n", "accuracy", "precision", "recall", "f1_score")

