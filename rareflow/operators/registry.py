"""Model registry as a table: one row per ``name_version``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "model_id string, name string, version string, model_type string, file_path string, "
    "performance_metrics map<string,double>, feature_count int, training_date string, "
    "model_size_mb double, status string, deployment_date string, hyperparameters map<string,string>"
)


def register(registry: DataFrame, entries: DataFrame) -> DataFrame:
    """Add entries; an existing ``model_id`` is replaced by its newest registration."""
    both = registry.unionByName(entries)
    whole = F.struct(*[c for c in both.columns])
    return both.groupBy("model_id").agg(F.max_by(whole, "training_date").alias("r")).select("r.*")


def list_models(registry: DataFrame, status: str | None = None) -> DataFrame:
    rows = registry if status is None else registry.where(F.col("status") == status)
    return rows.orderBy(F.col("training_date").desc(), "model_id")


def deprecate(registry: DataFrame, model_id: str) -> DataFrame:
    return registry.withColumn(
        "status", F.when(F.col("model_id") == model_id, "deprecated").otherwise(F.col("status"))
    )


def ranking(registry: DataFrame, metric: str = "test_roc_auc", default: float = 0.0) -> DataFrame:
    """Active models by a metric, highest first; a missing metric counts as ``default``."""
    value = F.coalesce(F.try_element_at("performance_metrics", F.lit(metric)), F.lit(default))
    return (
        registry.where(F.col("status") == "active")
        .select("model_id", value.alias("score"))
        .orderBy(F.col("score").desc(), "model_id")
    )


def best_model(registry: DataFrame, metric: str = "test_roc_auc") -> DataFrame:
    """The active model with the highest value; also the one to serve."""
    return ranking(registry, metric, -1.0).limit(1)


def export(registry: DataFrame) -> DataFrame:
    return registry.select("model_id", F.to_json(F.struct(*registry.columns)).alias("entry"))
