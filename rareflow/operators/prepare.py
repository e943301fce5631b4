"""Clean, derive, split, scale on train, and rebalance the training rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS
from rareflow.functions.timeparts import cyclic, hour_of_day, night_flag
from rareflow.operators import fitted, quality, sampling, scaling
from rareflow.session import stored

PARTS = (("train", 0.6), ("validation", 0.2), ("test", 0.2))


def prepare(df: DataFrame, imbalance: str | None = None, seed: int = 42) -> DataFrame:
    # written once: some ten jobs read it, and none repeats the join, the grouping or their plan
    clean = stored(quality.drop_null_rows(quality.drop_duplicate_rows(df, key="txn_id")), "clean-rows")
    split = sampling.stratified_split(clean, PARTS, seed=seed)
    train = split.where("split = 'train'")
    p = fitted.fit_amount_time(train)
    hour = hour_of_day()
    sin, cos = cyclic(hour, 24)
    derived = {
        "Hour": hour,
        "Hour_sin": sin,
        "Hour_cos": cos,
        "is_night": night_flag(hour, 23, 5),
        "Amount_log": F.log1p("Amount"),
        "Amount_decile": fitted.decile_code(p),
        "Amount_zscore": fitted.amount_columns(p)["Amount_zscore"],
    }
    wide = split.withColumns(derived)
    cols = [*V_COLS, "Amount", "Amount_log", "Amount_zscore", "Hour"]
    scaler = scaling.fit_robust(wide.where("split = 'train'"), cols)
    out = scaling.apply_scaler(wide, scaler).withColumn("copy", F.lit(0).cast("bigint"))
    if imbalance is None:
        return out
    train_rows = out.where("split = 'train'")
    if imbalance == "undersample":
        train_rows = sampling.undersample(train_rows, seed=seed)
    elif imbalance == "oversample":
        train_rows = sampling.oversample(train_rows.drop("copy"), seed=seed)
    else:
        raise ValueError(f"unknown imbalance method {imbalance!r}")
    return out.where("split <> 'train'").unionByName(train_rows)
