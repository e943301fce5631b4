"""Products, ratios and powers of named columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pairs, polynomial columns and the ranked list.
PAIRS = (
    ("V1", "V2"), ("V1", "V3"), ("V2", "V3"), ("V4", "V11"), ("V12", "V14"), ("V10", "V12"),
    ("Amount", "V1"), ("Amount", "V2"), ("Amount", "V14"), ("Time", "Amount"),
)
POLYNOMIALS = ("V1", "V2", "V3", "V4", "V14", "Amount")
RANKED_V = ("V17", "V14", "V12", "V10", "V16", "V3", "V7", "V11", "V4")
EPS = 1e-8


def product(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def safe_ratio(a, b, eps: float = EPS) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a, b + F.lit(eps))


def pair_features(pairs: Sequence[tuple[str, str]] = PAIRS) -> dict[str, Column]:
    out = {}
    for a, b in pairs:
        out[f"{a}_{b}_interaction"] = product(a, b)
        out[f"{a}_{b}_ratio"] = safe_ratio(a, b)
    return out


def ranked_products(names: Sequence[str] = RANKED_V, top: int = 6) -> dict[str, Column]:
    return {f"{a}_{b}_interaction": product(a, b) for a, b in combinations(names[:top], 2)}


def powers(names: Sequence[str] = POLYNOMIALS) -> dict[str, Column]:
    out = {}
    for c in names:
        x = F.col(c)
        out[f"{c}_squared"] = x * x
        out[f"{c}_cubed"] = x * x * x
    return out


def named_feature(name: str, columns: Sequence[str]) -> Column | None:
    """The expression behind a derived feature name; missing inputs count as 0."""

    def get(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in columns else F.lit(0.0)

    if name == "Time_Amount_ratio":
        amount = get("Amount") if "Amount" in columns else F.lit(1.0)
        return F.when(amount != 0, get("Time") / F.when(amount != 0, amount)).otherwise(0.0)
    base, _, kind = name.rpartition("_")
    if kind == "interaction" and base.count("_") == 1:
        a, b = base.split("_")
        return get(a) * get(b)
    if kind == "squared":
        return get(base) * get(base)
    if kind == "cubed":
        return get(base) * get(base) * get(base)
    return None
