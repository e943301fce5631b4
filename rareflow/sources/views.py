"""The transaction-shaped views every job reads, derived from the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS

EPOCH = "2024-01-01 00:00:00"
DRIFT_CUT = "2024-01-16 00:00:00"
#: So many vectors are broadcast, under 10 MB of doubles; more are shuffled.
BROADCAST_VECTORS = 40_000


# Declared, so that reading starts no job to look at file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def seconds_since_epoch(ts="ts") -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', {ts}) / 1000000D")


LABEL = "CASE WHEN event_type = 'error' AND user_id % 10 = 0 THEN 1 ELSE 0 END"


def label_column() -> Column:
    return F.expr(LABEL)


def labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without the V family: for jobs that only need time, amount and label."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS txn_id",
        "user_id",
        "ts",
        f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', ts) / 1000000D AS Time",
        "value AS Amount",
        f"{LABEL} AS Class",
        "event_type",
    )


def v_columns(embeddings: DataFrame, key: str = "vkey") -> DataFrame:
    """The V family of every vector, scaled to a standard deviation near one."""
    return embeddings.selectExpr(
        f"vec_id AS {key}",
        *[f"8.0D * CAST(element_at(embedding, {i}) AS DOUBLE) AS {c}" for i, c in enumerate(V_COLS, 1)],
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``txn_id, user_id, ts, Time, V1..V28, Amount, Class``.

    The size of ``embeddings`` comes from the Parquet footers and decides the join. Left to
    itself, the optimizer takes a few well compressed columns of many events for the smaller
    side and sends all of them through the driver.
    """
    emb = table(spark, sf_dir, "embeddings")
    n = emb.count()
    ev = labelled_events(spark, sf_dir).selectExpr("*", f"txn_id % {n}L AS vkey")
    vectors = v_columns(emb)
    vectors = F.broadcast(vectors) if n <= BROADCAST_VECTORS else vectors.hint("shuffle_hash")
    return ev.join(vectors, "vkey").select(
        "txn_id", "user_id", "ts", "Time", *V_COLS, "Amount", "Class"
    )


def score_column(multiplier: int = 7919, label="Class") -> Column:
    mixed = F.col("txn_id") * F.lit(multiplier)
    return (
        F.least(F.lit(999), mixed % 1000 - mixed % 5 + F.lit(200) * F.col(label)).cast("double")
        / 1000.0
    )


def scored(spark: SparkSession, sf_dir: str, multiplier: int = 7919) -> DataFrame:
    """``txn_id, label, score`` with many tied scores, and what later jobs break them down by."""
    return labelled_events(spark, sf_dir).select(
        "txn_id",
        F.col("Class").alias("label"),
        score_column(multiplier).alias("score"),
        "Amount",
        "ts",
        "user_id",
    )


def reference_and_current(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.expr(f"TIMESTAMP_NTZ'{DRIFT_CUT}'")
    return df.where(F.col("ts") < cut), df.where(F.col("ts") >= cut)


def with_drift(df: DataFrame) -> DataFrame:
    """Known drift for demonstrations: two linear shifts and one noise column."""
    return df.withColumns(
        {
            "V1": F.col("V1") * 1.1 + 0.1,
            "V2": F.col("V2") * 0.9 - 0.2,
        }
    )


def with_missing(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "V1": F.when(F.col("txn_id") % 97 != 0, F.col("V1")),
            "Amount": F.when(F.col("txn_id") % 89 != 0, F.col("Amount")),
        }
    )


def with_round_amounts(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "Amount",
        F.when(F.col("txn_id") % 50 == 0, F.lit(0.0))
        .when(F.col("txn_id") % 50 == 1, F.lit(100.0))
        .otherwise(F.col("Amount")),
    )


def with_duplicates(df: DataFrame) -> DataFrame:
    return df.unionByName(df.where(F.col("txn_id") < 10)).drop("txn_id")
