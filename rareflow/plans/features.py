"""Time, amount, row-statistic and interaction features (T, A, V and N rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions import interactions as ix
from rareflow.functions import rowstats
from rareflow.functions import timeparts as tp
from rareflow.functions.bands import AMOUNT_BINS_4, AMOUNT_BINS_6, right_closed_bins
from rareflow.functions.shape import V_COLS
from rareflow.operators import fitted
from rareflow.operators.chain import ADVANCED, BASELINE, apply_features, fit_features
from rareflow.operators.rolling import rolling
from rareflow.plans.catalog import EV, R, T, V_ARRAY, query, rounded
from rareflow.session import stored
from rareflow.sources.views import labelled_events, transactions, with_round_amounts

H = "((Time/3600.0) - 24.0*floor(Time/86400.0))"
D7 = "((Time/86400.0) - 7.0*floor(Time/604800.0))"


def _project(name, sql_cols, spark_cols, source=labelled_events, cte=EV, table="ev"):
    """Register a pure projection keyed by ``txn_id``."""
    sql = f"WITH {cte} SELECT txn_id, " + ", ".join(f"{e} AS {n}" for n, e in sql_cols.items()) + f" FROM {table}"

    @query(name, sql)
    def _(spark, sf):
        return rounded(
            source(spark, sf).select("txn_id", *[c.alias(n) for n, c in spark_cols().items()])
        )


def _flag(cond):
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


_project("T1_hour_of_day", {"Hour": R(H)}, lambda: {"Hour": tp.hour_of_day()})
_project(
    "T2_cyclic_hour",
    {"Hour_sin": R(f"sin(2*pi()*{H}/24)"), "Hour_cos": R(f"cos(2*pi()*{H}/24)")},
    lambda: dict(zip(("Hour_sin", "Hour_cos"), tp.cyclic(tp.hour_of_day(), 24))),
)
_project("T3_day_index", {"Day": "CAST(floor(Time/86400.0) AS INT)"}, lambda: {"Day": tp.day_index()})
_project(
    "T4_cyclic_day",
    {"Day_of_week": R(D7), "Day_sin": R(f"sin(2*pi()*{D7}/7)"), "Day_cos": R(f"cos(2*pi()*{D7}/7)")},
    lambda: {
        "Day_of_week": tp.day_of_week(),
        **dict(zip(("Day_sin", "Day_cos"), tp.cyclic(tp.day_of_week(), 7))),
    },
)


@query(
    "T5_normalized_time",
    f"WITH {EV}, p AS (SELECT MIN(Time) lo, MAX(Time) hi FROM ev) SELECT txn_id, {R('(Time-lo)/(hi-lo)')} AS Time_normalized, "
    f"{R('(Time-lo)/(hi-lo+1e-8)')} AS Time_normalized_eps FROM ev, p",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    lo, hi = df.agg(F.min("Time"), F.max("Time")).first()
    return rounded(
        df.select(
            "txn_id",
            tp.min_max("Time", lo, hi).alias("Time_normalized"),
            tp.min_max("Time", lo, hi, 1e-8).alias("Time_normalized_eps"),
        )
    )


_project(
    "T6_part_of_day",
    {
        "is_morning": _flag(f"{H} >= 5 AND {H} < 12"),
        "is_afternoon": _flag(f"{H} >= 12 AND {H} < 17"),
        "is_evening": _flag(f"{H} >= 17 AND {H} < 22"),
        "is_night": _flag(f"{H} >= 22 OR {H} < 5"),
    },
    lambda: tp.part_of_day(tp.hour_of_day()),
)
_project(
    "T7_night_variants",
    {"is_night_23_5": _flag(f"{H} >= 23 OR {H} <= 5"), "is_night_22_6": _flag(f"{H} >= 22 OR {H} <= 6")},
    lambda: {
        "is_night_23_5": tp.night_flag(tp.hour_of_day(), 23, 5),
        "is_night_22_6": tp.night_flag(tp.hour_of_day(), 22, 6),
    },
)
_project(
    "T8_weekend_variants",
    {
        "is_weekend": _flag("CAST(floor(Time/86400.0) AS INT) % 7 >= 5"),
        "is_weekend_fractional": _flag(f"{D7} >= 5"),
        "is_weekend_never": "0",
    },
    lambda: {
        "is_weekend": tp.weekend_flag(tp.day_index()),
        "is_weekend_fractional": tp.weekend_flag(tp.day_of_week()),
        "is_weekend_never": F.lit(0),
    },
)


@query(
    "A1_amount_transforms",
    f"WITH {EV}, p AS (SELECT MIN(Amount) lo, MAX(Amount) hi FROM ev) SELECT txn_id, {R('ln(1+Amount)')} AS Amount_log, {R('sqrt(Amount)')} AS Amount_sqrt, "
    f"{R('Amount*Amount')} AS Amount_squared, ROUND(Amount*Amount*Amount, 3) + CAST(0 AS DOUBLE) AS Amount_cubed, {R('(Amount-lo)/(hi-lo)')} AS Amount_normalized FROM ev, p",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    c = fitted.amount_columns(fitted.fit_amount_time(df))
    cubed = (F.round(c.pop("Amount_cubed"), 3) + F.lit(0.0)).alias("Amount_cubed")
    names = ("Amount_log", "Amount_sqrt", "Amount_squared", "Amount_normalized")
    return rounded(df.select("txn_id", *[c[x].alias(x) for x in names])).join(
        df.select("txn_id", cubed), "txn_id"
    )


def _fitted_amount(name, sql, columns, source=labelled_events):
    @query(name, sql)
    def _(spark, sf):
        df = source(spark, sf)
        return rounded(
            df.select("txn_id", *[c.alias(n) for n, c in columns(fitted.fit_amount_time(df)).items()])
        )


_EDGES = ", ".join(f"quantile_cont(Amount, {i / 10})" for i in range(11))
_fitted_amount(
    "A2_decile_code",
    f"WITH {EV}, q AS (SELECT list_sort(list_distinct([{_EDGES}])) AS e FROM ev), i AS (SELECT e[2:len(e)-1] AS e FROM q) "
    "SELECT txn_id, CAST(len(list_filter(e, lambda x: x < Amount)) AS INT) AS Amount_decile FROM ev, i",
    lambda p: {"Amount_decile": fitted.decile_code(p)},
)

ROUND_AMOUNTS = (
    "ra AS (SELECT * REPLACE (CASE WHEN txn_id % 50 = 0 THEN 0.0 WHEN txn_id % 50 = 1 THEN 100.0 ELSE Amount END AS Amount) FROM ev)"
)
_BIN6 = (
    "CASE WHEN Amount <= 0 THEN NULL WHEN Amount <= 10 THEN 'very_low' WHEN Amount <= 50 THEN 'low' WHEN Amount <= 100 THEN 'medium' "
    "WHEN Amount <= 500 THEN 'high' WHEN Amount <= 1000 THEN 'very_high' ELSE 'extreme' END"
)
_BIN4 = (
    "CASE WHEN Amount <= 0 THEN NULL WHEN Amount <= 10 THEN 'Very_Low' WHEN Amount <= 100 THEN 'Low' WHEN Amount <= 1000 THEN 'Medium' ELSE 'High' END"
)


def _rounds(spark, sf):
    return with_round_amounts(labelled_events(spark, sf))


_RA = {"source": _rounds, "cte": f"{EV}, {ROUND_AMOUNTS}", "table": "ra"}
_project("A3_amount_bin", {"Amount_bin": _BIN6}, lambda: {"Amount_bin": right_closed_bins("Amount", *AMOUNT_BINS_6)}, **_RA)
_project("A4_amount_category", {"Amount_category": _BIN4}, lambda: {"Amount_category": right_closed_bins("Amount", *AMOUNT_BINS_4)}, **_RA)
_project(
    "A5_category_dummies",
    {f"Amount_{x}": f"CASE WHEN {_BIN4} = '{x}' THEN 1 ELSE 0 END" for x in AMOUNT_BINS_4[1]},
    lambda: fitted.category_dummies(right_closed_bins("Amount", *AMOUNT_BINS_4)),
    **_RA,
)
_project(
    "A6_round_amount",
    {"is_round_10": _flag("Amount % 10 < 0.01"), "is_round_100": _flag("Amount % 100 < 0.01")},
    lambda: {
        "is_round_10": tp.flag(F.pmod(F.col("Amount"), F.lit(10.0)) < 0.01),
        "is_round_100": tp.flag(F.pmod(F.col("Amount"), F.lit(100.0)) < 0.01),
    },
    **_RA,
)
_fitted_amount(
    "A7_above_percentile",
    f"WITH {EV}, p AS (SELECT " + ", ".join(f"quantile_cont(Amount, {k / 100}) AS q{k}" for k in fitted.ABOVE)
    + " FROM ev) SELECT txn_id, " + ", ".join(f"CASE WHEN Amount > q{k} THEN 1 ELSE 0 END AS Amount_above_p{k}" for k in fitted.ABOVE) + " FROM ev, p",
    fitted.above_percentile,
)
_fitted_amount(
    "A8_high_low_flags",
    f"WITH {EV}, p AS (SELECT quantile_cont(Amount, 0.25) a, quantile_cont(Amount, 0.75) b, quantile_cont(Amount, 0.95) c FROM ev) "
    "SELECT txn_id, CASE WHEN Amount > c THEN 1 ELSE 0 END AS is_high_amount, CASE WHEN Amount <= a THEN 1 ELSE 0 END AS is_low, "
    "CASE WHEN Amount >= b THEN 1 ELSE 0 END AS is_high, CASE WHEN Amount >= c THEN 1 ELSE 0 END AS is_very_high FROM ev, p",
    lambda p: {
        "is_high_amount": tp.flag(F.col("Amount") > p.quantiles[0.95]),
        "is_low": tp.flag(F.col("Amount") <= p.quantiles[0.25]),
        "is_high": tp.flag(F.col("Amount") >= p.quantiles[0.75]),
        "is_very_high": tp.flag(F.col("Amount") >= p.quantiles[0.95]),
    },
)


@query(
    "A9_percentile_rank",
    f"WITH {EV}, {ROUND_AMOUNTS} SELECT txn_id, " + R("(RANK() OVER (ORDER BY Amount) + (COUNT(*) OVER (PARTITION BY Amount) - 1)/2.0)/COUNT(*) OVER ()") + " AS Amount_percentile FROM ra",
)
def _(spark, sf):
    return rounded(fitted.percentile_rank(_rounds(spark, sf)).select("txn_id", "Amount_percentile"))


_fitted_amount(
    "A10_amount_zscore",
    f"WITH {EV}, p AS (SELECT AVG(Amount) m, STDDEV_SAMP(Amount) s FROM ev) SELECT txn_id, {R('ABS((Amount-m)/s)')} AS Amount_zscore FROM ev, p",
    lambda p: {"Amount_zscore": F.abs((F.col("Amount") - p.mean) / p.std)},
)

# ---- row statistics ---------------------------------------------------------

_TV = {"source": transactions, "cte": T, "table": "t"}
_A = V_ARRAY


def _row(name, sql_cols, pick, cte=T, table="t"):
    sql = f"WITH {cte} SELECT txn_id, " + ", ".join(f"{e} AS {n}" for n, e in sql_cols.items()) + f" FROM {table}"

    @query(name, sql)
    def _(spark, sf):
        df = rowstats.add_row_statistics(transactions(spark, sf), V_COLS, pick)
        return rounded(df.select("txn_id", *pick))


_row("V1_mean_sum", {"V_mean": R(f"list_avg({_A})"), "V_sum": R(f"list_sum({_A})")}, ["V_mean", "V_sum"])
_row("V2_std", {"V_std": R(f"list_aggregate({_A}, 'stddev_samp')")}, ["V_std"])
_row(
    "V3_min_max_range",
    {"V_min": R(f"list_min({_A})"), "V_max": R(f"list_max({_A})"), "V_range": R(f"list_max({_A}) - list_min({_A})")},
    ["V_min", "V_max", "V_range"],
)
_row("V4_median", {"V_median": R(f"list_median({_A})")}, ["V_median"])
_row("V5_skew", {"V_skew": R(f"list_aggregate({_A}, 'skewness')")}, ["V_skew"])
_row("V6_kurtosis", {"V_kurt": R(f"list_aggregate({_A}, 'kurtosis')")}, ["V_kurt"])
_row("V7_high_count", {"V_high_count": f"CAST(len(list_filter({_A}, lambda x: ABS(x) > 2)) AS INT)"}, ["V_high_count"])
_ABS = f"list_sum(list_transform({_A}, lambda x: ABS(x)))"


_row(
    "V8_entropy",
    {"V_entropy": R("-list_sum(list_transform(v, lambda x: (ABS(x)/tot)*ln(ABS(x)/tot + 1e-8)))")},
    ["V_entropy"],
    cte=f"{T}, s AS (SELECT txn_id, {_A} AS v, {_ABS} + 1e-8 AS tot FROM t)",
    table="s",
)
_row(
    "V9_mean_abs_deviation",
    {"V_mad": R("list_avg(list_transform(v, lambda x: ABS(x-m)))")},
    ["V_mad"],
    cte=f"{T}, s AS (SELECT txn_id, {_A} AS v, list_avg({_A}) AS m FROM t)",
    table="s",
)
_row(
    "V10_sign_counts",
    {
        f"V_{n}_count": f"CAST(len(list_filter({_A}, lambda x: x {op} 0)) AS INT)"
        for n, op in (("neg", "<"), ("pos", ">"), ("zero", "="))
    },
    ["V_neg_count", "V_pos_count", "V_zero_count"],
)

# ---- interactions -----------------------------------------------------------


@query(
    "N1_time_amount_interactions",
    f"WITH {EV}, p AS (SELECT MIN(Time) lo, MAX(Time) hi FROM ev) SELECT txn_id, ROUND(Amount/((Time-lo)/(hi-lo+1e-8)+1e-8), 2) + CAST(0 AS DOUBLE) AS Amount_per_time, "
    f"{R(f'Amount*{H}')} AS Amount_hour FROM ev, p",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    c = fitted.interaction_columns(fitted.fit_amount_time(df))
    per_time = F.round(c["Amount_per_time"], 2) + F.lit(0.0)
    return df.select(
        "txn_id", per_time.alias("Amount_per_time"), (F.round(c["Amount_hour"], 6) + 0.0).alias("Amount_hour")
    )


_fitted_amount(
    "N2_high_amount_at_night",
    f"WITH {EV}, p AS (SELECT quantile_cont(Amount, 0.9) q FROM ev) SELECT txn_id, CASE WHEN Amount > q AND ({H} >= 22 OR {H} < 5) THEN 1 ELSE 0 END AS high_amount_night FROM ev, p",
    lambda p: {"high_amount_night": fitted.interaction_columns(p)["high_amount_night"]},
)


@query(
    "N3_top_variance_interactions",
    f"WITH {T}, u AS (UNPIVOT (SELECT txn_id, Amount, {', '.join(V_COLS)} FROM t) ON {', '.join(V_COLS)} INTO NAME feature VALUE value), "
    "top AS (SELECT feature FROM u GROUP BY feature ORDER BY VAR_SAMP(value) DESC LIMIT 5) "
    f"SELECT txn_id, feature, {R('value/(Amount+1e-8)')} AS amount_ratio, {R('value*Amount')} AS amount_product FROM u SEMI JOIN top USING (feature)",
)
def _(spark, sf):
    df = transactions(spark, sf)
    p = fitted.fit_amount_time(df, V_COLS)
    c = fitted.interaction_columns(p)
    rows = F.array(
        *[
            F.struct(
                F.lit(v).alias("feature"),
                c[f"{v}_Amount_ratio"].alias("amount_ratio"),
                c[f"{v}_Amount_product"].alias("amount_product"),
            )
            for v in p.top_variance
        ]
    )
    return rounded(df.select("txn_id", F.inline(rows)))


@query(
    "N4_pair_features",
    f"WITH {T} SELECT txn_id, "
    + ", ".join(
        f"ROUND({a}*{b}, 3) + CAST(0 AS DOUBLE) AS {a}_{b}_interaction, "
        f"CASE WHEN ABS({a}/({b}+1e-8)) < 1000 THEN ROUND({a}/({b}+1e-8), 6) + CAST(0 AS DOUBLE) END AS {a}_{b}_ratio"
        for a, b in ix.PAIRS
    )
    + " FROM t",
)
def _(spark, sf):
    out = []
    for name, c in ix.pair_features().items():
        if name.endswith("_interaction"):
            c = F.round(c, 3) + F.lit(0.0)
        else:
            c = F.when(F.abs(c) < 1000, F.round(c, 6) + F.lit(0.0))
        out.append(c.alias(name))
    return transactions(spark, sf).select("txn_id", *out)


_TOP6 = ix.RANKED_V[:6]
_project(
    "N5_ranked_products",
    {f"{a}_{b}_interaction": R(f"{a}*{b}") for i, a in enumerate(_TOP6) for b in _TOP6[i + 1 :]},
    ix.ranked_products,
    **_TV,
)
_project(
    "N6_powers",
    {k: R(e) for c in ix.POLYNOMIALS for k, e in ((f"{c}_squared", f"{c}*{c}"), (f"{c}_cubed", f"{c}*{c}*{c}"))},
    lambda: ix.powers(ix.POLYNOMIALS),
    **_TV,
)
_NAMED = ("V1_V2_interaction", "V4_V11_interaction", "Amount_V14_interaction", "Time_Amount_ratio", "V3_cubed", "V14_squared")


@query(
    "N7_named_features",
    f"WITH {EV}, {ROUND_AMOUNTS}, {T.split(EV + ', ', 1)[1]} SELECT t.txn_id, {R('V1*V2')} AS V1_V2_interaction, {R('0')} AS V4_V11_interaction, "
    f"{R('ra.Amount*V14')} AS Amount_V14_interaction, CASE WHEN ra.Amount <> 0 THEN ROUND(t.Time/ra.Amount, 4) ELSE 0 END + CAST(0 AS DOUBLE) AS Time_Amount_ratio, "
    f"{R('V3*V3*V3')} AS V3_cubed, {R('V14*V14')} AS V14_squared FROM t JOIN ra USING (txn_id)",
)
def _(spark, sf):
    df = with_round_amounts(transactions(spark, sf)).drop("V11")
    cols = {n: ix.named_feature(n, df.columns) for n in _NAMED}
    ratio = (F.round(cols.pop("Time_Amount_ratio"), 4) + F.lit(0.0)).alias("Time_Amount_ratio")
    return df.select(
        "txn_id", ratio, *[(F.round(c, 6) + F.lit(0.0)).alias(n) for n, c in cols.items()]
    )


@query("N8_baseline_features")
def _(spark, sf):
    df = transactions(spark, sf)
    return apply_features(df, fit_features(df, BASELINE))


@query("N8_advanced_features")
def _(spark, sf):
    df = stored(rolling(transactions(spark, sf)), "rolling-rows")
    return apply_features(df, fit_features(df, ADVANCED))
