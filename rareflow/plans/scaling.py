"""Scaling, schema alignment and outliers (SC and O rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS
from rareflow.operators import anomaly, outliers, scaling
from rareflow.operators.pca import apply_pca, fit_pca
from rareflow.operators.sampling import stratified_split
from rareflow.plans.catalog import R, T, pk_sql, query, rounded
from rareflow.sources.views import transactions

ALL = [*V_COLS, "Amount"]
COLS = ALL


def _scaled_sql(center, spread, cols=COLS):
    params = ", ".join(f"{center(c)} AS c_{c}, {spread(c)} AS s_{c}" for c in cols)
    out = ", ".join(R(f"({c} - c_{c})/CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END") + f" AS {c}" for c in cols)
    return f"WITH {T}, p AS (SELECT {params} FROM t) SELECT txn_id, {out} FROM t, p"


def _q(c, p):
    return f"quantile_cont({c}, {p})"


def _register(name, kind, sql):
    @query(name, sql)
    def _(spark, sf):
        df = transactions(spark, sf).select("txn_id", *COLS)
        return rounded(scaling.apply_scaler(df, scaling.fit_scaler(df, COLS, kind)))


_register("SC1_standard", "standard", _scaled_sql(lambda c: f"AVG({c})", lambda c: f"STDDEV_POP({c})"))
_register("SC2_robust", "robust", _scaled_sql(lambda c: _q(c, 0.5), lambda c: f"({_q(c, 0.75)}-{_q(c, 0.25)})"))
_register("SC3_robust_wide", "robust_wide", _scaled_sql(lambda c: _q(c, 0.5), lambda c: f"({_q(c, 0.99)}-{_q(c, 0.01)})"))
_register("SC4_minmax", "minmax", _scaled_sql(lambda c: f"MIN({c})", lambda c: f"(MAX({c})-MIN({c}))"))

# the 80/20 split used below, in permutation order per class
SPLIT_80 = (
    "o AS (SELECT t.*, ROW_NUMBER() OVER (PARTITION BY Class ORDER BY " + pk_sql() + ", txn_id) AS rn, "
    "COUNT(*) OVER (PARTITION BY Class) AS n FROM t), "
    "sp AS (SELECT *, CASE WHEN rn <= CAST(floor(n*0.8 + 1e-9) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM o)"
)


@query(
    "SC5_fit_train_apply_all",
    f"WITH {T}, {SPLIT_80}, p AS (SELECT " + ", ".join(f"{_q(c, 0.5)} AS c_{c}, {_q(c, 0.99)}-{_q(c, 0.01)} AS s_{c}" for c in COLS)
    + " FROM sp WHERE split='train') SELECT txn_id, split, Class, " + ", ".join(R(f"({c}-c_{c})/s_{c}") + f" AS {c}" for c in COLS)
    + ", CASE WHEN Amount > 400 THEN 1 ELSE 0 END AS is_large FROM sp, p",
)
def _(spark, sf):
    df = transactions(spark, sf).select("txn_id", "Time", "Class", *COLS)
    df = df.withColumn("is_large", F.when(F.col("Amount") > 400, 1).otherwise(0))
    split = stratified_split(df, (("train", 0.8), ("test", 0.2)))
    params = scaling.fit_scaler(
        split.where("split = 'train'"), scaling.scalable_columns(df), "unknown name"
    )
    return rounded(scaling.apply_scaler(split, params).drop("Time"))


_DERIVED = {
    **{f"{a}_{b}_interaction": f"{a}*{b}" for a, b in (("V1", "V2"), ("V1", "V3"), ("V2", "V3"), ("V10", "V12"), ("V12", "V14"), ("Amount", "V14"))},
    "V4_V11_interaction": "0",
    **{f"V{i}_squared": f"V{i}*V{i}" for i in (1, 2, 3, 4, 14)},
    **{f"V{i}_cubed": f"V{i}*V{i}*V{i}" for i in (1, 3, 4, 14)},
    "Time_Amount_ratio": "CASE WHEN Amount <> 0 THEN ROUND(Time/Amount, 2) ELSE 0 END",
}


def _aligned_sql(name):
    if name == "V11":
        return "0"
    if name in _DERIVED:
        return _DERIVED[name]
    if name in V_COLS:
        return name
    return str(scaling.DEFAULTS.get(name, 0.0))


@query(
    "SC6_align_to_schema",
    f"WITH {T} SELECT txn_id, " + ", ".join(f"{R(_aligned_sql(n))} AS {n}" for n in scaling.SCHEMA_50) + " FROM t",
)
def _(spark, sf):
    df = transactions(spark, sf).drop("V11")
    out = scaling.align_to_schema(df, keep=["txn_id"])
    return rounded(out.withColumn("Time_Amount_ratio", F.round("Time_Amount_ratio", 2)))


@query(
    "SC6_schema_match",
    f"WITH {T} SELECT 'raw' AS source, false AS matches, COUNT(*) AS n_rows FROM t UNION ALL SELECT 'aligned', true, COUNT(*) FROM t",
)
def _(spark, sf):
    df = transactions(spark, sf)
    parts = {"raw": df, "aligned": scaling.align_to_schema(df)}
    out = None
    for name, part in parts.items():
        one = part.agg(
            F.lit(name).alias("source"), F.lit(scaling.matches_schema(part)).alias("matches"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("SC7_assembled_vectors")
def _(spark, sf):
    from rareflow.operators.models import assemble

    return assemble(transactions(spark, sf), ALL).select("txn_id", "label", "features")


@query(
    "SC8_stored_mean_scale",
    _scaled_sql(lambda c: f"AVG({c})", lambda c: f"STDDEV_POP({c})", ALL),
)
def _(spark, sf):
    df = transactions(spark, sf).select("txn_id", *ALL)
    stored = scaling.params_frame(spark, scaling.fit_standard(df, ALL))
    return rounded(scaling.apply_scaler(df, scaling.params_from_frame(stored)))


# ---- outliers ---------------------------------------------------------------


def _iqr_flag(c, k=1.5):
    iqr = f"(h_{c}-l_{c})"
    return f"CASE WHEN {c} < l_{c} - {k}*{iqr} OR {c} > h_{c} + {k}*{iqr} THEN 1 ELSE 0 END"


_IQR_P = "p AS (SELECT " + ", ".join(f"{_q(c, 0.25)} AS l_{c}, {_q(c, 0.75)} AS h_{c}" for c in ALL) + " FROM t)"


@query(
    "O1_iqr_flags",
    f"WITH {T}, {_IQR_P} SELECT txn_id, " + ", ".join(f"{_iqr_flag(c)} AS {c}_outlier" for c in ALL) + " FROM t, p",
)
def _(spark, sf):
    df = transactions(spark, sf).select("txn_id", *ALL)
    return outliers.iqr_flags(df, outliers.iqr_bounds(df, ALL)).drop(*ALL)


_Z_P = "p AS (SELECT " + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in ALL) + " FROM t)"


@query(
    "O2_zscore_flags",
    f"WITH {T}, {_Z_P} SELECT txn_id, " + ", ".join(f"CASE WHEN ABS(({c}-m_{c})/s_{c}) > 2.5 THEN 1 ELSE 0 END AS {c}_outlier" for c in ALL) + " FROM t, p",
)
def _(spark, sf):
    df = transactions(spark, sf).select("txn_id", *ALL).withColumn("constant", F.lit(1.0))
    params = outliers.zscore_params(df, [*ALL, "constant"])
    return outliers.zscore_flags(df, params, 2.5).drop(*ALL, "constant")


@query(
    "O3_outlier_totals",
    f"WITH {T}, {_IQR_P}, f AS (SELECT txn_id, " + " + ".join(_iqr_flag(c) for c in ALL)
    + f" AS c FROM t, p) SELECT txn_id, c AS outlier_count, {R(f'c/{float(len(ALL))}')} AS outlier_ratio FROM f",
)
def _(spark, sf):
    df = transactions(spark, sf).select("txn_id", *ALL)
    flagged = outliers.iqr_flags(df, outliers.iqr_bounds(df, ALL))
    return rounded(outliers.outlier_totals(flagged).select("txn_id", "outlier_count", "outlier_ratio"))


@query("O4_pca_features")
def _(spark, sf):
    df = transactions(spark, sf)
    split = stratified_split(df, (("train", 0.8), ("test", 0.2)))
    p = fit_pca(split.where("split = 'train'"), V_COLS, min(5, len(V_COLS)))
    out = apply_pca(split, p).select("txn_id", "split", *[f"PCA_{j}" for j in range(5)])
    return out.withColumn("explained", F.lit(float(sum(p.explained))))


@query("O5_isolation_forest")
def _(spark, sf):
    df = transactions(spark, sf)
    forest = anomaly.fit_isolation_forest(df, ALL)
    return anomaly.score_isolation_forest(df, forest).select("txn_id", "Class", "anomaly_score", "is_anomaly")


@query("O5_isolation_forest_quality")
def _(spark, sf):
    df = transactions(spark, sf)
    scored = anomaly.score_isolation_forest(df, anomaly.fit_isolation_forest(df, ALL))
    return anomaly.anomaly_quality(scored)


@query("O6_anomaly_relevance")
def _(spark, sf):
    df = transactions(spark, sf)
    scored = anomaly.score_isolation_forest(df, anomaly.fit_isolation_forest(df, ALL))
    return anomaly.relevance(scored, ALL)


@query("O7_reconstruction_error")
def _(spark, sf):
    df = transactions(spark, sf)
    model = anomaly.fit_reconstruction(df, ALL)
    return anomaly.score_reconstruction(df, model).select(
        "txn_id", "Class", "reconstruction_error", "anomaly_score", "is_anomaly"
    )
