"""Cleaning and data quality (Q rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS
from rareflow.operators import outliers, quality
from rareflow.plans.catalog import EV, I, R, T, V_LIST, query, rounded
from rareflow.sources.views import (
    labelled_events,
    transactions,
    with_duplicates,
    with_missing,
)

CHECKED = ["V1", "V2", "V3", "Amount"]
MISSING = (
    "m AS (SELECT txn_id, user_id, ts, Time, CASE WHEN txn_id % 97 <> 0 THEN V1 END AS V1, "
    + ", ".join(V_COLS[1:])
    + ", CASE WHEN txn_id % 89 <> 0 THEN Amount END AS Amount, Class FROM t)"
)


@query(
    "Q1_drop_duplicates",
    f"WITH {T}, d AS (SELECT user_id, Time, {V_LIST}, Amount, Class FROM t UNION ALL "
    f"SELECT user_id, Time, {V_LIST}, Amount, Class FROM t WHERE txn_id < 10), "
    "x AS (SELECT DISTINCT * FROM d) "
    "SELECT user_id, " + R("Time") + " AS Time, " + R("V1") + " AS V1, " + R("Amount") + " AS Amount, Class FROM x",
)
def _(spark, sf):
    df = with_duplicates(transactions(spark, sf)).drop("ts")
    return rounded(
        quality.drop_duplicate_rows(df).select("user_id", "Time", "V1", "Amount", "Class")
    )


@query(
    "Q1_duplicate_report",
    f"WITH {T}, d AS (SELECT user_id, Time, {V_LIST}, Amount, Class FROM t UNION ALL "
    f"SELECT user_id, Time, {V_LIST}, Amount, Class FROM t WHERE txn_id < 10), "
    "x AS (SELECT COUNT(*) n FROM d GROUP BY ALL) "
    f"SELECT {I('SUM(n)')} AS rows_before, COUNT(*) AS rows_after, {I('SUM(n-1)')} AS duplicates FROM "
    f"(SELECT COUNT(*) n FROM d GROUP BY user_id, Time, {V_LIST}, Amount, Class) x",
)
def _(spark, sf):
    return quality.duplicate_report(with_duplicates(transactions(spark, sf)).drop("ts"))


_EVERY = ["user_id", "Time", *V_COLS, "Amount", "Class"]


@query(
    "Q2_drop_null_rows",
    f"WITH {T}, {MISSING} SELECT txn_id, user_id, {R('Time')} AS Time, " + ", ".join(f"{R(c)} AS {c}" for c in V_COLS)
    + f", {R('Amount')} AS Amount, Class FROM m WHERE ts IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in _EVERY),
)
def _(spark, sf):
    df = with_missing(transactions(spark, sf))
    return rounded(quality.drop_null_rows(df).select("txn_id", *_EVERY))


def _fill_sql(fn):
    return (
        f"WITH {T}, {MISSING}, p AS (SELECT {fn('V1')} v, {fn('Amount')} a FROM m) "
        f"SELECT txn_id, {R('COALESCE(V1, v)')} AS V1, {R('COALESCE(Amount, a)')} AS Amount FROM m, p"
    )


@query("Q3_fill_median", _fill_sql(lambda c: f"quantile_cont({c}, 0.5)"))
def _(spark, sf):
    df = with_missing(transactions(spark, sf)).select("txn_id", "V1", "Amount")
    return rounded(quality.fill_missing(df, quality.fit_fill_values(df, ["V1", "Amount"])))


@query("Q3_fill_mean", _fill_sql(lambda c: f"AVG({c})"))
def _(spark, sf):
    df = with_missing(transactions(spark, sf)).select("txn_id", "V1", "Amount")
    values = quality.fit_fill_values(df, ["V1", "Amount"], "mean")
    return rounded(quality.fill_missing(df, values))


def _iqr_bounds_sql(cols, k=1.5):
    return ", ".join(
        f"quantile_cont({c},0.25) - {k}*(quantile_cont({c},0.75)-quantile_cont({c},0.25)) AS lo_{c}, "
        f"quantile_cont({c},0.75) + {k}*(quantile_cont({c},0.75)-quantile_cont({c},0.25)) AS hi_{c}"
        for c in cols
    )


@query(
    "Q4_drop_iqr_outliers",
    f"WITH {T}, p AS (SELECT {_iqr_bounds_sql(CHECKED)} FROM t) "
    f"SELECT txn_id, {R('V1')} AS V1, {R('Amount')} AS Amount FROM t, p WHERE "
    + " AND ".join(f"{c} BETWEEN lo_{c} AND hi_{c}" for c in CHECKED),
)
def _(spark, sf):
    df = transactions(spark, sf).select("txn_id", *CHECKED)
    kept = outliers.drop_iqr_outliers(df, outliers.iqr_bounds(df, CHECKED))
    return rounded(kept.select("txn_id", "V1", "Amount"))


@query(
    "Q4_drop_zscore_outliers",
    f"WITH {T}, p AS (SELECT "
    + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in CHECKED)
    + f" FROM t) SELECT txn_id, {R('V1')} AS V1, {R('Amount')} AS Amount FROM t, p WHERE "
    + " AND ".join(f"ABS(({c} - m_{c})/s_{c}) <= 2.5" for c in CHECKED),
)
def _(spark, sf):
    df = transactions(spark, sf).select("txn_id", *CHECKED)
    kept = outliers.drop_zscore_outliers(df, outliers.zscore_params(df, CHECKED), 2.5)
    return rounded(kept.select("txn_id", "V1", "Amount"))


@query(
    "Q5_schema_errors",
    f"WITH {T} SELECT column_name, 'missing required column ' || column_name AS error, (SELECT COUNT(*) FROM t) AS rows_affected FROM "
    "(VALUES ('Class'), ('V28')) x(column_name)",
)
def _(spark, sf):
    df = transactions(spark, sf).drop("Class", "V28")
    errors = quality.schema_errors(df, ["Time", *V_COLS, "Amount", "Class"])
    return errors.withColumn("rows_affected", F.lit(df.count()))


@query(
    "Q6_quality_report",
    f"WITH {T}, {MISSING}, d AS (SELECT V1, V2, V3, Amount, Class FROM m), p AS (SELECT {_iqr_bounds_sql(CHECKED)} FROM d) "
    "SELECT COUNT(*) AS n_rows, " + I(" + ".join(f"(COUNT(*) - COUNT({c}))" for c in CHECKED)) + " AS missing_cells, "
    + I(" + ".join(f"COUNT(*) FILTER ({c} < lo_{c} OR {c} > hi_{c})" for c in CHECKED))
    + f" AS outlier_cells, COUNT(*) FILTER (Class=1) AS positives, {R('AVG(Class)')} AS positive_rate, "
    "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d)) AS duplicate_rows FROM d, p",
)
def _(spark, sf):
    return rounded(quality.quality_report(with_missing(transactions(spark, sf)), CHECKED))


_INVALID = (
    "i AS (SELECT txn_id, Time, CASE WHEN txn_id % 101 = 0 THEN -Amount ELSE Amount END AS Amount, "
    "CASE WHEN txn_id % 103 = 0 THEN NULL ELSE user_id END AS user_id, "
    "CASE WHEN txn_id % 107 = 0 THEN 2 ELSE Class END AS Class FROM ev)"
)


@query(
    "Q7_failed_rules",
    f"WITH {EV}, {_INVALID}, f AS (SELECT txn_id, list_filter([CASE WHEN user_id IS NULL THEN 'user_id is null' END, "
    "CASE WHEN Amount < 0 THEN 'Amount below zero' END, CASE WHEN Amount > 480 THEN 'Amount above limit' END, "
    "CASE WHEN Time < 0 OR Time > 2500000 THEN 'Time out of range' END, "
    "CASE WHEN Class NOT IN (0,1) THEN 'label not binary' END], lambda x: x IS NOT NULL) AS r FROM i) "
    "SELECT txn_id, array_to_string(r, '; ') AS failed FROM f WHERE len(r) > 0",
)
def _(spark, sf):
    df = labelled_events(spark, sf).withColumns(
        {
            "Amount": F.when(F.col("txn_id") % 101 == 0, -F.col("Amount")).otherwise(F.col("Amount")),
            "user_id": F.when(F.col("txn_id") % 103 != 0, F.col("user_id")),
            "Class": F.when(F.col("txn_id") % 107 == 0, 2).otherwise(F.col("Class")),
        }
    )
    rules = quality.row_rules(["user_id"], amount_max=480.0, time_max=2_500_000.0)
    _, bad = quality.split_quarantine(df, rules)
    return bad.select("txn_id", F.array_join("failed_rules", "; ").alias("failed"))


@query(
    "Q8_rate_check",
    f"WITH {EV}, s AS (SELECT COUNT(*) AS n_rows, AVG(Class) AS r FROM ev) SELECT n_rows, {R('r')} AS positive_rate, "
    "r <= 0.01 AND r > 0 AS valid, CASE WHEN r = 0 THEN 'no positives' WHEN r > 0.01 THEN 'positive rate unusually high' ELSE 'ok' END AS message, "
    "n_rows < 100000 AS small_data FROM s",
)
def _(spark, sf):
    return rounded(quality.rate_check(labelled_events(spark, sf)))


@query(
    "Q9_feature_validity",
    f"WITH {T}, m AS (SELECT V1, CASE WHEN txn_id % 3 = 0 THEN V2 END AS V2, CAST(1 AS DOUBLE) AS V3, Time, Amount FROM t), s AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, MIN({c}) AS mn, MAX({c}) AS mx, VAR_POP({c}) AS v, AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS ns FROM m"
        for c in ("V1", "V2", "V3", "Time", "Amount")
    )
    + "), z AS (SELECT *, CASE WHEN ns > 0.5 THEN 'mostly null' WHEN v IS NULL OR v <= 1e-12 THEN 'constant' "
    "WHEN GREATEST(ABS(mn), ABS(mx)) > 1e6 THEN 'out of range' ELSE 'ok' END AS reason FROM s) "
    f"SELECT feature, {R('mn')} AS min, {R('mx')} AS max, {R('ns')} AS null_share, reason, reason = 'ok' AS valid FROM z",
)
def _(spark, sf):
    df = transactions(spark, sf).withColumns(
        {"V2": F.when(F.col("txn_id") % 3 == 0, F.col("V2")), "V3": F.lit(1.0)}
    )
    out = quality.feature_validity(df, ["V1", "V2", "V3", "Time", "Amount"])
    return rounded(out.drop("variance"))
