"""Column expressions on seconds since the first transaction."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_of_day(t="Time") -> Column:
    """Continuous hour in [0, 24)."""
    return F.pmod(_c(t) / 3600.0, F.lit(24.0))


def cyclic(x, period: float) -> tuple[Column, Column]:
    angle = F.lit(2.0 * math.pi) * _c(x) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def day_index(t="Time") -> Column:
    return F.floor(_c(t) / 86400.0).cast("int")


def day_of_week(t="Time") -> Column:
    """Fractional day modulo a week."""
    return F.pmod(_c(t) / 86400.0, F.lit(7.0))


def flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def part_of_day(hour) -> dict[str, Column]:
    h = _c(hour)
    return {
        "is_morning": flag((h >= 5) & (h < 12)),
        "is_afternoon": flag((h >= 12) & (h < 17)),
        "is_evening": flag((h >= 17) & (h < 22)),
        "is_night": flag((h >= 22) | (h < 5)),
    }


def night_flag(hour, start: float, end: float) -> Column:
    """Night from ``start`` to ``end``, both ends included."""
    return flag((_c(hour) >= start) | (_c(hour) <= end))


def weekend_flag(day) -> Column:
    return flag(F.pmod(_c(day), F.lit(7)) >= 5)


def min_max(x, lo: float, hi: float, eps: float = 0.0) -> Column:
    """Fitted min-max; a zero range gives null unless ``eps`` guards it."""
    return F.try_divide(_c(x) - F.lit(lo), F.lit(hi) - F.lit(lo) + F.lit(eps))
