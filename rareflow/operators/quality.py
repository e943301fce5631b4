"""Cleaning and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.shape import stats_by_feature
from rareflow.operators.outliers import iqr_bounds, iqr_flags
from rareflow.operators.quantiles import exact_quantiles


def drop_duplicate_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """One row per distinct content; ``key`` does not count as content.

    Copies fold on the map side, so a row repeated many times is no hot group.
    """
    cols = [c for c in df.columns if c != key]
    if key is None or key not in df.columns:
        return df.dropDuplicates(cols)
    return df.groupBy(*cols).agg(F.min(key).alias(key)).select(*df.columns)


def duplicate_report(df: DataFrame) -> DataFrame:
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.sum(F.col("_n") - 1).alias("duplicates"),
    )


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def fit_fill_values(df: DataFrame, cols: Sequence[str], strategy: str = "median") -> dict[str, float]:
    if strategy == "median":
        return {c: v[0] for c, v in exact_quantiles(df, {c: F.col(c) for c in cols}, [0.5]).items()}
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    raise ValueError(f"unknown strategy {strategy!r}")


def fill_missing(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.na.fill({c: v for c, v in values.items() if v is not None})


def schema_errors(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Missing required columns, one row each; no rows means valid."""
    spark = df.sparkSession

    def names(xs):
        return spark.createDataFrame([(x,) for x in xs], "column_name string")

    missing = names(required).join(names(df.columns), "column_name", "left_anti")
    return missing.withColumn("error", F.concat(F.lit("missing required column "), F.col("column_name")))


def validate_schema(df: DataFrame, required: Sequence[str]) -> tuple[bool, list[str]]:
    errors = [r.error for r in schema_errors(df, required).orderBy("column_name").collect()]
    return not errors, errors


def quality_report(df: DataFrame, cols: Sequence[str], target: str = "Class") -> DataFrame:
    """One row: size, missing cells, duplicate rows, IQR outlier cells and class counts."""
    flagged = iqr_flags(df, iqr_bounds(df, cols))
    counts = flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0)).alias("missing_cells"),
        sum((F.coalesce(F.sum(f"{c}_outlier"), F.lit(0)) for c in cols), F.lit(0)).alias(
            "outlier_cells"
        ),
        F.count_if(F.col(target) == 1).alias("positives"),
        F.avg(target).alias("positive_rate"),
    )
    duplicates = duplicate_report(df.select(*cols, target)).select("duplicates").first()[0]
    return counts.withColumn("duplicate_rows", F.lit(duplicates))


def row_rules(
    required: Sequence[str], amount_max: float, time_max: float, target: str = "Class"
) -> dict[str, Column]:
    """Rule name -> predicate that is true when the row breaks it."""
    rules = {f"{c} is null": F.col(c).isNull() for c in required}
    rules["Amount below zero"] = F.col("Amount") < 0
    rules["Amount above limit"] = F.col("Amount") > amount_max
    rules["Time out of range"] = (F.col("Time") < 0) | (F.col("Time") > time_max)
    rules["label not binary"] = ~F.col(target).isin(0, 1)
    return rules


def with_failed_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    failed = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.withColumn("failed_rules", failed)


def split_quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    marked = with_failed_rules(df, rules)
    bad = F.size("failed_rules") > 0
    return marked.where(~bad).drop("failed_rules"), marked.where(bad)


def rate_check(
    df: DataFrame, target: str = "Class", max_rate: float = 0.01, min_rows: int = 100_000
) -> DataFrame:
    s = df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(target).alias("positive_rate"))
    high = F.col("positive_rate") > max_rate
    return s.select(
        "*",
        (~high & (F.col("positive_rate") > 0)).alias("valid"),
        F.when(F.col("positive_rate") == 0, "no positives")
        .when(high, "positive rate unusually high")
        .otherwise("ok")
        .alias("message"),
        (F.col("n_rows") < min_rows).alias("small_data"),
    )


def feature_validity(
    df: DataFrame,
    cols: Sequence[str],
    max_null_share: float = 0.5,
    min_variance: float = 1e-12,
    max_abs: float = 1e6,
) -> DataFrame:
    s = stats_by_feature(
        df,
        cols,
        {
            "min": F.min,
            "max": F.max,
            "variance": F.var_pop,
            "null_share": lambda c: F.avg(F.when(c.isNull(), 1.0).otherwise(0.0)),
        },
    )
    reason = (
        F.when(F.col("null_share") > max_null_share, "mostly null")
        .when(F.col("variance").isNull() | (F.col("variance") <= min_variance), "constant")
        .when(F.greatest(F.abs("min"), F.abs("max")) > max_abs, "out of range")
        .otherwise("ok")
    )
    return s.withColumn("reason", reason).withColumn("valid", F.col("reason") == "ok")
