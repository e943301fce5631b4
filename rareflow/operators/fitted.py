"""Time and amount features whose thresholds are fitted once and reused."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions import timeparts as tp
from rareflow.functions.bands import AMOUNT_BINS_4, AMOUNT_BINS_6, right_closed_bins
from rareflow.functions.interactions import safe_ratio
from rareflow.operators.ordering import average_ranks, fits_broadcast, lookup_by_value
from rareflow.operators.quantiles import exact_quantiles

DECILES = tuple(i / 10 for i in range(11))
ABOVE = (25, 50, 75, 90, 95, 99)


@dataclass(frozen=True)
class AmountParams:
    low: float
    high: float
    mean: float
    std: float
    quantiles: dict[float, float]
    time_low: float
    time_high: float
    top_variance: list[str] = field(default_factory=list)


def fit_amount_time(df: DataFrame, v_cols: Sequence[str] = (), top: int = 5) -> AmountParams:
    """Everything later features need, in two passes over the table."""
    row = df.agg(
        F.min("Amount").alias("lo"), F.max("Amount").alias("hi"), F.avg("Amount").alias("m"),
        F.stddev_samp("Amount").alias("s"), F.min("Time").alias("t0"), F.max("Time").alias("t1"),
        *[F.var_samp(c).alias(f"v_{c}") for c in v_cols],
    ).first()
    probs = sorted({*DECILES, *(p / 100 for p in ABOVE)})
    q = exact_quantiles(df, {"a": F.col("Amount")}, probs)["a"]
    ranked = sorted(v_cols, key=lambda c: -(row[f"v_{c}"] or 0.0))[:top]
    return AmountParams(
        row.lo, row.hi, row.m, row.s, dict(zip(probs, q)), row.t0, row.t1, ranked
    )


def time_columns(p: AmountParams) -> dict[str, Column]:
    hour = tp.hour_of_day()
    s, c = tp.cyclic(hour, 24)
    week = tp.day_of_week()
    ds, dc = tp.cyclic(week, 7)
    return {
        "Hour": hour,
        "Hour_sin": s,
        "Hour_cos": c,
        "Day": tp.day_index(),
        "Day_of_week": week,
        "Day_sin": ds,
        "Day_cos": dc,
        "Time_normalized": tp.min_max("Time", p.time_low, p.time_high, 1e-8),
        **tp.part_of_day(hour),
        "is_weekend": tp.weekend_flag(tp.day_index()),
    }


def decile_code(p: AmountParams, x: str = "Amount") -> Column:
    """0-based code: how many distinct inner edges lie below the value."""
    edges = sorted({p.quantiles[d] for d in DECILES})
    code = F.lit(0)
    for e in edges[1:-1]:
        code = code + (F.col(x) > F.lit(e)).cast("int")
    return code


def amount_columns(p: AmountParams) -> dict[str, Column]:
    a = F.col("Amount")
    return {
        "Amount_log": F.log1p(a),
        "Amount_sqrt": F.sqrt(a),
        "Amount_squared": a * a,
        "Amount_cubed": a * a * a,
        "Amount_normalized": tp.min_max("Amount", p.low, p.high),
        "Amount_decile": decile_code(p),
        "Amount_bin": right_closed_bins("Amount", *AMOUNT_BINS_6),
        "Amount_category": right_closed_bins("Amount", *AMOUNT_BINS_4),
        "is_round_10": tp.flag(F.pmod(a, F.lit(10.0)) < 0.01),
        "is_round_100": tp.flag(F.pmod(a, F.lit(100.0)) < 0.01),
        "is_high_amount": tp.flag(a > p.quantiles[0.95]),
        "Amount_zscore": F.abs(F.try_divide(a - F.lit(p.mean), F.lit(p.std))),
    }


def above_percentile(p: AmountParams) -> dict[str, Column]:
    return {
        f"Amount_above_p{k}": tp.flag(F.col("Amount") > p.quantiles[k / 100]) for k in ABOVE
    }


def category_dummies(category: Column) -> dict[str, Column]:
    """One 0/1 column per known label; a null category is 0 everywhere."""
    return {
        f"Amount_{label}": F.coalesce((category == F.lit(label)).cast("int"), F.lit(0))
        for label in AMOUNT_BINS_4[1]
    }


def percentile_rank(df: DataFrame, value: str = "Amount", out: str = "Amount_percentile") -> DataFrame:
    """Average rank divided by the number of rows."""
    total = df.count()
    ranks = average_ranks(df.select(value), value).select(
        value, "n", (F.col("rank") / F.lit(float(total))).alias(out)
    )
    small = fits_broadcast(df, value)
    return lookup_by_value(df, ranks, value, total, broadcast=small).drop("n")


def interaction_columns(p: AmountParams) -> dict[str, Column]:
    tn = tp.min_max("Time", p.time_low, p.time_high, 1e-8)
    hour = tp.hour_of_day()
    a = F.col("Amount")
    out = {
        "Amount_per_time": safe_ratio(a, tn),
        "Amount_hour": a * hour,
        "high_amount_night": tp.flag((a > p.quantiles[0.9]) & ((hour >= 22) | (hour < 5))),
    }
    for c in p.top_variance:
        out[f"{c}_Amount_ratio"] = safe_ratio(c, "Amount")
        out[f"{c}_Amount_product"] = F.col(c) * a
    return out
