"""Ordered labels from numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin edges and labels.
AMOUNT_BINS_6 = ((0, 10, 50, 100, 500, 1000, None), ("very_low", "low", "medium", "high", "very_high", "extreme"))
AMOUNT_BINS_4 = ((0, 10, 100, 1000, None), ("Very_Low", "Low", "Medium", "High"))
PSI_MINOR, PSI_MAJOR = 0.1, 0.25


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def right_closed_bins(x, edges: Sequence[float | None], labels: Sequence[str]) -> Column:
    """(e0, e1] .. (ek, inf]; values at or below the first edge are null."""
    out = F.when(_c(x) <= edges[0], F.lit(None))
    for hi, label in zip(edges[1:], labels):
        out = out.when(F.lit(True) if hi is None else _c(x) <= hi, F.lit(label))
    return F.when(_c(x).isNotNull(), out)


def amount_band(x) -> Column:
    return (
        F.when(_c(x) < 50, "0-50").when(_c(x) < 200, "50-200").when(_c(x) < 1000, "200-1000")
        .otherwise("1000+")
    )


def drift_severity(psi, minor: float = PSI_MINOR, major: float = PSI_MAJOR) -> Column:
    return (
        F.when(_c(psi).isNull() | F.isnan(_c(psi)), "Unknown")
        .when(_c(psi) > major, "Major drift")
        .when(_c(psi) > minor, "Minor drift")
        .otherwise("No drift")
    )


def confidence(score) -> Column:
    s = _c(score)
    return (
        F.when((s >= 0.8) | (s <= 0.2), "high").when((s >= 0.6) | (s <= 0.4), "medium")
        .otherwise("low")
    )


def risk_level(score) -> Column:
    return F.when(_c(score) > 0.8, "HIGH").when(_c(score) > 0.5, "MEDIUM").otherwise("LOW")


def degradation_status(pct, warning: float = 5.0, critical: float = 10.0) -> Column:
    return F.when(_c(pct) > critical, "CRITICAL").when(_c(pct) > warning, "WARNING").otherwise("OK")
