"""Small results as JSON and CSV, and fitted state as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """Reports are a few rows: one file."""
    writer = df.coalesce(1).write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def read_report(spark: SparkSession, path: str, schema: str, kind: str = "json") -> DataFrame:
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.option("header", True).csv(path) if kind == "csv" else reader.json(path)


def write_selection(
    spark: SparkSession, path: str, names: Sequence[str], scores: Mapping[str, float]
) -> None:
    rows = [(i, n, float(scores.get(n, 0.0))) for i, n in enumerate(names)]
    write_report(spark.createDataFrame(rows, "position int, feature string, score double"), path)


def read_selection(spark: SparkSession, path: str) -> list[str]:
    df = read_report(spark, path, "position int, feature string, score double")
    return [r.feature for r in df.orderBy("position").collect()]


def feature_info(
    spark: SparkSession,
    original: Sequence[str],
    engineered: Sequence[str],
    selected: Sequence[str],
    scores: Mapping[str, float],
    scaler: Mapping[str, tuple[float, float]],
) -> DataFrame:
    """One row of fitted feature metadata."""
    schema = (
        "original_features array<string>, engineered_features array<string>, "
        "selected_features array<string>, feature_scores array<double>, "
        "scaler_params struct<mean: array<double>, scale: array<double>>, "
        "n_original_features int, n_engineered_features int, n_selected_features int"
    )
    means = [scaler[c][0] for c in selected if c in scaler]
    scales = [scaler[c][1] for c in selected if c in scaler]
    row = (
        list(original), list(engineered), list(selected),
        [float(scores.get(c, 0.0)) for c in selected],
        (means, scales), len(original), len(engineered), len(selected),
    )
    return spark.createDataFrame([row], schema).withColumn("created_at", F.current_timestamp())
