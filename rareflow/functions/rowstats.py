"""Statistics across one row's numeric family.

Arithmetic over the named columns, with no shuffle and no Python per row. The row
mean and the central moments are computed once and shared. Two short sums are folds
over an array: Spark compiles a projection with a fold into many small methods. All
statistics written out in one method are too long for the JVM to optimize, and it
interprets them for every row, ten times as slow.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMES = (
    "V_mean", "V_sum", "V_std", "V_min", "V_max", "V_range", "V_median", "V_skew", "V_kurt",
    "V_high_count", "V_entropy", "V_mad", "V_neg_count", "V_pos_count", "V_zero_count",
)
EPS = "1e-8D"


def _sum(cols: Sequence[str], term: Callable[[str], str]) -> Column:
    return F.expr(" + ".join(term(c) for c in cols))


def _fold(cols: Sequence[str], term: Callable[[Column], Column]) -> Column:
    """The sum of a term over the columns, added from left to right."""
    return F.aggregate(F.array(*cols), F.lit(0.0), lambda total, x: total + term(x))


def _count(cols: Sequence[str], cond: str) -> Column:
    return _sum(cols, lambda c: f"CAST({cond.format(c)} AS INT)")


def _median(cols: Sequence[str]) -> Column:
    s, n = F.sort_array(F.array(*cols)), len(cols)
    return (F.element_at(s, (n + 1) // 2) + F.element_at(s, n // 2 + 1)) / 2.0


def _skew(n: int) -> Column:
    """Bias-corrected G1; null when the row is constant."""
    m2, m3 = F.col("_s2") / n, F.col("_s3") / n
    return F.try_divide(m3, m2 * F.sqrt(m2)) * (n * (n - 1)) ** 0.5 / (n - 2)


def _kurt(n: int) -> Column:
    """Bias-corrected excess G2; null when the row is constant."""
    m2, m4 = F.col("_s2") / n, F.col("_s4") / n
    g2 = F.try_divide(m4, m2 * m2) - 3.0
    return ((n + 1) * g2 + 6.0) * ((n - 1) / ((n - 2) * (n - 3)))


def add_row_statistics(
    df: DataFrame, cols: Sequence[str], names: Sequence[str] = NAMES, high: float = 2.0
) -> DataFrame:
    n = len(cols)
    want = set(names)
    temps = ["_sum", "_mean"]
    df = df.withColumn("_sum", _sum(cols, str)).withColumn("_mean", F.col("_sum") / float(n))
    powers = {"V_std": [2], "V_skew": [2, 3], "V_kurt": [2, 4]}
    moments = sorted({p for name in want & set(powers) for p in powers[name]})
    second = {
        f"_s{p}": _sum(cols, lambda c, p=p: "*".join([f"({c} - _mean)"] * p)) for p in moments
    }
    if "V_entropy" in want:
        second["_abs"] = _fold(cols, F.abs) + F.expr(EPS)
    if second:
        df = df.withColumns(second)
        temps += list(second)
    out = {
        "V_mean": lambda: F.col("_mean"),
        "V_sum": lambda: F.col("_sum"),
        "V_std": lambda: F.sqrt(F.col("_s2") / float(n - 1)),
        "V_min": lambda: F.least(*cols),
        "V_max": lambda: F.greatest(*cols),
        "V_range": lambda: F.greatest(*cols) - F.least(*cols),
        "V_median": lambda: _median(cols),
        "V_skew": lambda: _skew(n),
        "V_kurt": lambda: _kurt(n),
        "V_high_count": lambda: _count(cols, f"abs({{}}) > {high}D"),
        "V_entropy": lambda: -_sum(cols, lambda c: f"abs({c})/_abs * ln(abs({c})/_abs + {EPS})"),
        "V_mad": lambda: _fold(cols, lambda x: F.abs(x - F.col("_mean"))) / float(n),
        "V_neg_count": lambda: _count(cols, "{} < 0D"),
        "V_pos_count": lambda: _count(cols, "{} > 0D"),
        "V_zero_count": lambda: _count(cols, "{} = 0D"),
    }
    return df.withColumns({k: out[k]() for k in names}).drop(*temps)
