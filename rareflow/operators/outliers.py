"""Outlier bounds fitted once, applied as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.operators.quantiles import exact_quantiles

Bounds = Mapping[str, tuple[float, float]]


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> Bounds:
    q = exact_quantiles(df, {c: F.col(c) for c in cols}, [0.25, 0.75])
    return {c: (a - k * (b - a), b + k * (b - a)) for c, (a, b) in q.items() if a is not None}


def zscore_params(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample standard deviation; columns without spread are left out."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols],
        *[F.stddev_samp(c).alias(f"s_{c}") for c in cols],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols if row[f"s_{c}"]}


def iqr_flags(df: DataFrame, bounds: Bounds) -> DataFrame:
    return df.withColumns(
        {
            f"{c}_outlier": ((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).cast("int")
            for c, (lo, hi) in bounds.items()
        }
    )


def zscore_flags(
    df: DataFrame, params: Mapping[str, tuple[float, float]], threshold: float = 3.0
) -> DataFrame:
    return df.withColumns(
        {
            f"{c}_outlier": (F.abs((F.col(c) - m) / s) > F.lit(float(threshold))).cast("int")
            for c, (m, s) in params.items()
        }
    )


def outlier_totals(df: DataFrame) -> DataFrame:
    """Number and share of raised flags per row."""
    flags = [c for c in df.columns if c.endswith("_outlier")]
    total = F.lit(0)
    for c in flags:
        total = total + F.coalesce(F.col(c), F.lit(0))
    df = df.withColumn("outlier_count", total)
    return df.withColumn("outlier_ratio", F.col("outlier_count") / F.lit(float(max(1, len(flags)))))


def drop_iqr_outliers(df: DataFrame, bounds: Bounds) -> DataFrame:
    keep = F.lit(True)
    for c, (lo, hi) in bounds.items():
        keep = keep & (F.col(c) >= lo) & (F.col(c) <= hi)
    return df.where(keep)


def drop_zscore_outliers(
    df: DataFrame, params: Mapping[str, tuple[float, float]], threshold: float = 3.0
) -> DataFrame:
    keep = F.lit(True)
    for c, (m, s) in params.items():
        keep = keep & (F.abs((F.col(c) - m) / s) <= F.lit(float(threshold)))
    return df.where(keep)
