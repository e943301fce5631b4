"""The whole feature set in its fixed order, with switches, fitted once and reused."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from rareflow.functions import rowstats
from rareflow.functions.shape import V_COLS
from rareflow.operators import fitted, outliers, pca, rolling, scaling


@dataclass(frozen=True)
class Switches:
    time: bool = True
    amount: bool = True
    row_statistics: bool = True
    interactions: bool = True
    rolling: bool = False
    outliers: bool = True
    pca: bool = False
    scale: bool = True
    scaler: str = "robust"


BASELINE = Switches(interactions=False)
ADVANCED = replace(Switches(), rolling=True, pca=True)


@dataclass(frozen=True)
class FittedFeatures:
    switches: Switches
    amounts: fitted.AmountParams
    bounds: outliers.Bounds
    components: pca.PcaParams | None
    scaler: Mapping[str, scaling.Scale]


RAW = [*V_COLS, "Amount"]


def has_rolling(df: DataFrame) -> bool:
    """Whether the rolling features are there already, so that windows run once for fit and apply."""
    return any(c.startswith("positive_rate_rolling_") for c in df.columns)


def _derived(df: DataFrame, s: Switches, p: fitted.AmountParams) -> DataFrame:
    if s.rolling and not has_rolling(df):  # needs raw columns only, so it moves the narrow rows
        df = rolling.rolling(df)
    if s.row_statistics:
        df = rowstats.add_row_statistics(df, V_COLS)
    cols = {}
    if s.time:
        cols.update(fitted.time_columns(p))
    if s.amount:
        cols.update(fitted.amount_columns(p))
    if s.interactions:
        cols.update(fitted.interaction_columns(p))
    return df.withColumns(cols)


def _scaled_columns(df: DataFrame) -> list[str]:
    skip = ("Class", "Time", "txn_id", "user_id")
    flags = ("high_amount_night",)
    return [c for c in scaling.scalable_columns(df, skip) if c not in flags]


def fit_features(df: DataFrame, switches: Switches = Switches()) -> FittedFeatures:
    """Learn every threshold on training rows."""
    amounts = fitted.fit_amount_time(df, V_COLS)
    bounds = outliers.iqr_bounds(df, RAW) if switches.outliers else {}
    components = pca.fit_pca(df, V_COLS, 5, standardize=True) if switches.pca else None
    scaler = {}
    if switches.scale:
        wide = _derived(df, switches, amounts)
        wide = wide.select(*_scaled_columns(wide)).persist()  # read by every quantile pass
        scaler = scaling.fit_scaler(wide, wide.columns, switches.scaler)
        wide.unpersist()
    return FittedFeatures(switches, amounts, bounds, components, scaler)


def apply_features(df: DataFrame, f: FittedFeatures) -> DataFrame:
    """Derived columns, then outliers, PCA and scaling.

    Rolling features read raw columns only, so computing them first changes no value.
    """
    out = _derived(df, f.switches, f.amounts)
    if f.switches.outliers:
        out = outliers.outlier_totals(outliers.iqr_flags(out, f.bounds))
    if f.components is not None:
        out = pca.apply_pca(out, f.components)
    return scaling.apply_scaler(out, f.scaler)
