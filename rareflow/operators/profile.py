"""Profiling aggregates over a labelled table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rareflow.functions.keys import perm_key
from rareflow.functions.shape import numeric_columns, stats_by_feature
from rareflow.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)
SUFFIX_GROUPS = (
    ("interaction", r"_interaction$|_ratio$"),
    ("polynomial", r"_squared$|_cubed$"),
    ("row statistic", r"^V_"),
    ("v family", r"^V\d+$"),
    ("time", r"^Time"),
    ("amount", r"^Amount"),
)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def column_groups(df: DataFrame, target: str = "Class") -> DataFrame:
    """Column name, type and the name group later steps go by."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type_name"))
            for c, t in df.dtypes
        ]
    )
    group = F.when(F.col("column_name") == target, "target")
    for name, pattern in SUFFIX_GROUPS:
        group = group.when(F.col("column_name").rlike(pattern), name)
    one = df.sparkSession.range(1)
    return one.select(F.inline(rows)).withColumn("name_group", group.otherwise("other"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return stats_by_feature(df, cols, {"nulls": lambda c: F.count_if(c.isNull())})


def class_balance(df: DataFrame, target: str = "Class") -> DataFrame:
    one = F.col(target) == 1
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(one).alias("positives"),
        F.count_if(~one).alias("negatives"),
    )
    return counts.select(
        "*",
        F.try_divide("positives", "total").alias("positive_rate"),
        (F.try_divide("positives", "total") * 100).alias("positive_pct"),
        F.try_divide("negatives", "positives").alias("imbalance"),
    )


def describe(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per column."""
    base = stats_by_feature(
        df,
        cols,
        {
            "n": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": F.min,
            "max": F.max,
        },
    )
    q = exact_quantiles(df, {c: F.col(c) for c in cols}, probs)
    names = [f"p{round(p * 100)}" for p in probs]
    rows = [(c, *q[c]) for c in cols]
    qdf = small_frame(
        df.sparkSession, rows, "feature string, " + ", ".join(f"{n} double" for n in names)
    )
    return base.join(F.broadcast(qdf), "feature")


def describe_by_class(
    df: DataFrame, value: str, target: str = "Class", classes: Sequence[int] = (0, 1)
) -> DataFrame:
    wide = df.select(
        *[F.when(F.col(target) == k, F.col(value)).alias(f"class_{k}") for k in classes]
    )
    return describe(wide, wide.columns).select(
        F.regexp_extract("feature", r"class_(\d+)", 1).cast("int").alias(target),
        "n", "mean", "std", "min", "p25", "p50", "p75", "max",
    )


def target_correlation(df: DataFrame, cols: Sequence[str], target: str = "Class") -> DataFrame:
    return stats_by_feature(df, cols, {"corr": lambda c: F.corr(c, F.col(target).cast("double"))})


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str = "pearson"):
    """k x k matrix as a NumPy array (k = number of columns)."""
    vec = df.select(array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])).alias("_v"))
    return Correlation.corr(vec, "_v", method).first()[0].toArray()


def correlation_pairs(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    m = correlation_matrix(df, cols, method)
    rows = [
        (a, b, float(m[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)
    ]
    return small_frame(df.sparkSession, rows, "left string, right string, corr double")


def histogram(df: DataFrame, value: str, target: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the whole range, the last one closed, counted per class."""
    lo, hi = df.agg(F.min(value), F.max(value)).first()
    width = (hi - lo) / bins
    bin_no = F.least(F.lit(bins - 1), F.floor((F.col(value) - lo) / width)).cast("int")
    counts = df.where(F.col(value).isNotNull()).groupBy(target, bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(Window.partitionBy(target))
    return counts.withColumn("density", F.col("n") / (total * F.lit(width)))


def feature_statistics(df: DataFrame, cols: Sequence[str], target: str = "Class") -> DataFrame:
    base = stats_by_feature(
        df,
        cols,
        {
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": F.min,
            "max": F.max,
            "nulls": lambda c: F.count_if(c.isNull()),
            "class_0_mean": lambda c: F.avg(F.when(F.col(target) == 0, c)),
            "class_1_mean": lambda c: F.avg(F.when(F.col(target) == 1, c)),
        },
    )
    medians = exact_quantiles(df, {c: F.col(c) for c in cols}, [0.5])
    med = small_frame(
        df.sparkSession, [(c, medians[c][0]) for c in cols], "feature string, median double"
    )
    diff = F.abs(F.col("class_1_mean") - F.col("class_0_mean"))
    return (
        base.join(F.broadcast(med), "feature")
        .join(F.broadcast(distinct_counts(df, cols)), "feature")
        .withColumn("class_mean_diff", diff)
        .withColumn("class_mean_diff_ratio", diff / (F.abs("class_0_mean") + 1e-8))
    )


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct values per column: one row per (feature, value) after a partial aggregate."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value"
    )
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("feature", "value").agg(F.lit(1).alias("_one"))
        .groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_values"))
    )


def take_per_class(
    df: DataFrame, limits: dict[int, int | None], target: str = "Class", key: str = "txn_id",
    seed: int = 42,
) -> DataFrame:
    """All rows of a class, or its first n in permutation order."""
    parts = []
    for k, n in limits.items():
        part = df.where(F.col(target) == k)
        if n is not None:
            pk = perm_key(key, seed)
            part = part.orderBy(pk, key).limit(n)
        parts.append(part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dataset_summary(df: DataFrame, target: str = "Class") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col(target)).cast("bigint").alias("positives"),
        F.avg(F.col(target)).alias("positive_rate"),
        F.min("Amount").alias("amount_min"),
        F.max("Amount").alias("amount_max"),
        F.avg("Amount").alias("amount_mean"),
        ((F.max("Time") - F.min("Time")) / 3600.0).alias("span_hours"),
        F.lit(len(numeric_columns(df))).cast("bigint").alias("numeric_columns"),
    )
