"""Reading and writing transaction tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.keys import normal_draw, perm_key, unit_draw
from rareflow.functions.shape import V_COLS
from rareflow.operators.sampling import before, cut_rows

TRANSACTIONS = ", ".join(["Time double", *[f"{c} double" for c in V_COLS], "Amount double", "Class int"])


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Works on any file system the session can reach."""
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str, schema: str = TRANSACTIONS) -> DataFrame:
    """Header CSV with a declared schema; a missing path or a malformed row fails."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_csv_tree(spark: SparkSession, path: str, schema: str = TRANSACTIONS) -> DataFrame:
    """Every CSV below a folder."""
    return (
        spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path)
    )


def stored_or_created(
    spark: SparkSession, path: str, make: Callable[[], DataFrame], force: bool = False
) -> DataFrame:
    """Read the finished table at ``path``, or build and store it first."""
    if force or not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_parts(df: DataFrame, path: str, *by: str, kind: str = "parquet") -> None:
    """One folder per split (and variant)."""
    writer = df.write.mode("overwrite").partitionBy(*by)
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def append_predictions(predictions: DataFrame, path: str) -> None:
    """Add rows below one folder per day and model version.

    Spark splits a busy day and joins quiet ones by the bytes they turn out to have
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so files have about that size.
    """
    even = predictions.hint("rebalance", F.col("created_date"), F.col("model_version"))
    even.write.mode("append").partitionBy("created_date", "model_version").parquet(path)


def synthetic(
    spark: SparkSession, n: int, ratio: float, seed: int = 42,
    shift: dict[str, float] | None = None, span: float = 172800.0,
) -> DataFrame:
    """Labelled random rows with exactly int(n * ratio) positives.

    Row i gets a time in the i-th of n equal slots, so times come out sorted, and
    the positives are the rows with the smallest permutation keys, found by a cut. All
    draws come from keys, so the table does not depend on partitions.
    """
    want = int(n * ratio)
    ids = spark.range(n).withColumnRenamed("id", "txn_id")
    rows = cut_rows(ids, F.lit(0), {0: [want]}, "txn_id", seed)
    positive = before(rows.get((0, want)), "txn_id", seed)
    df = ids.withColumn("Class", F.when(positive, 1).otherwise(0))
    shift = shift or {c: 1.0 for c in V_COLS[:15]}
    vs = {
        c: normal_draw("txn_id", seed + i) + F.col("Class") * F.lit(float(shift.get(c, 0.0)))
        for i, c in enumerate(V_COLS, 1)
    }
    amount = F.abs(normal_draw("txn_id", seed + 100) * 150.0 + 100.0)
    time = (F.col("txn_id") + unit_draw("txn_id", seed + 101)) * F.lit(span / max(1, n))
    return df.withColumns({"Time": time, **vs, "Amount": amount}).select(
        "txn_id", "Time", *V_COLS, "Amount", "Class"
    )


def small_sample(
    df: DataFrame, positives: int = 10, negatives: int = 990, target: str = "Class",
    key: str = "txn_id", seed: int = 42,
) -> DataFrame:
    """A few rows with both classes present, in shuffled order."""
    pk = perm_key(key, seed)
    parts = [
        df.where(F.col(target) == k).orderBy(pk, key).limit(n) for k, n in ((1, positives), (0, negatives))
    ]
    return parts[0].unionByName(parts[1]).withColumn("shuffle_key", pk).orderBy("shuffle_key", key)
