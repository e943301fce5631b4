"""Scalers: one fitting aggregate, then literal-folded projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.interactions import named_feature
from rareflow.functions.shape import numeric_columns
from rareflow.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Scale:
    center: float
    scale: float


Params = Mapping[str, Scale]


def _scale(center, spread) -> Scale:
    return Scale(float(center), float(spread) if spread else 1.0)


def fit_standard(df: DataFrame, cols: Sequence[str]) -> Params:
    """Mean and population standard deviation."""
    row = df.agg(
        *[F.avg(c).alias(f"a_{c}") for c in cols], *[F.stddev_pop(c).alias(f"b_{c}") for c in cols]
    ).first()
    return {c: _scale(row[f"a_{c}"], row[f"b_{c}"]) for c in cols}


def fit_robust(df: DataFrame, cols: Sequence[str], low: float = 0.25, high: float = 0.75) -> Params:
    """Median and the range between two quantiles."""
    q = exact_quantiles(df, {c: F.col(c) for c in cols}, [low, 0.5, high])
    return {c: _scale(m, b - a) for c, (a, m, b) in q.items()}


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> Params:
    row = df.agg(
        *[F.min(c).alias(f"a_{c}") for c in cols], *[F.max(c).alias(f"b_{c}") for c in cols]
    ).first()
    return {c: _scale(row[f"a_{c}"], row[f"b_{c}"] - row[f"a_{c}"]) for c in cols}


def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "robust") -> Params:
    """``standard``, ``minmax``, ``robust`` (25-75 %); anything else is ``robust_wide`` (1-99 %)."""
    if kind == "standard":
        return fit_standard(df, cols)
    if kind == "minmax":
        return fit_minmax(df, cols)
    if kind == "robust":
        return fit_robust(df, cols)
    return fit_robust(df, cols, 0.01, 0.99)


def scalable_columns(df: DataFrame, skip: Sequence[str] = ("Class", "Time", "txn_id", "user_id")) -> list[str]:
    """Numeric columns that are neither keys nor 0/1 flags."""
    return [
        c for c in numeric_columns(df, skip) if not c.startswith("is_") and not c.endswith("_outlier")
    ]


def scaled(c: str, p: Scale) -> Column:
    return (F.col(c) - F.lit(p.center)) / F.lit(p.scale)


def apply_scaler(df: DataFrame, params: Params) -> DataFrame:
    return df.withColumns({c: scaled(c, p) for c, p in params.items() if c in df.columns})


def params_frame(spark: SparkSession, params: Params) -> DataFrame:
    """The fitted state as a small table."""
    return spark.createDataFrame(
        [(c, *asdict(p).values()) for c, p in params.items()],
        "feature string, center double, scale double",
    )


def params_from_frame(df: DataFrame) -> Params:
    return {r.feature: Scale(r.center, r.scale) for r in df.collect()}


# The fifty model inputs in order, and the defaults of absent ones.
SCHEMA_50 = (
    "V1 V2 V3 V4 V5 V6 V7 V8 V9 V10 V11 V12 V14 V16 V17 V18 V19 V20 V21 V27 "
    "Time_hour Time_hour_sin Amount_above_p25 "
    "V_mean V_std V_min V_max V_range V_median V_skew V_kurt V_neg_count V_pos_count "
    "V1_V2_interaction V1_V3_interaction V2_V3_interaction V4_V11_interaction "
    "V12_V14_interaction V10_V12_interaction Amount_V14_interaction Time_Amount_ratio "
    "V1_squared V1_cubed V2_squared V3_squared V3_cubed V4_squared V4_cubed V14_squared V14_cubed"
).split()
DEFAULTS = {"Time_hour": 12.0, "V_std": 1.0, "V_neg_count": 14.0, "V_pos_count": 14.0}


def matches_schema(df: DataFrame, names: Sequence[str] = SCHEMA_50) -> bool:
    return list(df.columns) == list(names)


def align_to_schema(df: DataFrame, names: Sequence[str] = SCHEMA_50, keep: Sequence[str] = ()) -> DataFrame:
    """Select the model inputs in order; absent ones are computed or get their default."""

    def source(name: str) -> Column:
        if name in df.columns:
            return F.col(name).cast("double")
        derived = named_feature(name, df.columns)
        return F.lit(DEFAULTS.get(name, 0.0)) if derived is None else derived

    return df.select(*keep, *[source(n).alias(n) for n in names])
