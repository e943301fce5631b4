"""Profiling and exploratory aggregates (P rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions import rowstats, timeparts
from rareflow.functions.bands import amount_band
from rareflow.functions.shape import V_COLS, stats_by_feature
from rareflow.operators import evaluation as ev
from rareflow.operators import profile as pr
from rareflow.operators.pca import project_components
from rareflow.operators.quantiles import exact_quantiles
from rareflow.operators.sampling import permutation_sample
from rareflow.plans.catalog import EV, I, R, S, T, V_ARRAY, V_LIST, pk_sql, query, r6, rounded
from rareflow.sources.views import labelled_events, scored, transactions, with_missing

FEATURES = [*V_COLS, "Amount"]
WIDE = [*V_COLS, "Time", "Amount"]
UT = f"u AS (UNPIVOT (SELECT txn_id, Class, {V_LIST}, Time, Amount FROM t) ON {V_LIST}, Time, Amount INTO NAME feature VALUE value)"


@query(
    "P1_table_shape",
    f"WITH {T} SELECT COUNT(*) AS n_rows, CAST(34 AS BIGINT) AS n_columns FROM t",
)
def _(spark, sf):
    return pr.table_shape(transactions(spark, sf))


_TYPES = (
    [("txn_id", "bigint"), ("user_id", "bigint"), ("ts", "timestamp_ntz"), ("Time", "double")]
    + [(v, "double") for v in V_COLS]
    + [("Amount", "double"), ("Class", "int")]
)


@query(
    "P1_column_groups",
    f"WITH {T}, n AS (SELECT COUNT(*) AS present FROM t) SELECT column_name, type_name, present, CASE WHEN column_name='Class' THEN 'target' "
    "WHEN regexp_matches(column_name, '^V[0-9]+$') THEN 'v family' "
    "WHEN column_name LIKE 'Time%' THEN 'time' WHEN column_name LIKE 'Amount%' THEN 'amount' "
    "ELSE 'other' END AS name_group FROM (VALUES "
    + ", ".join(f"('{c}','{t}')" for c, t in _TYPES)
    + ") x(column_name, type_name), n",
)
def _(spark, sf):
    df = transactions(spark, sf)
    present = stats_by_feature(df, df.columns, {"present": F.count})
    return pr.column_groups(df).join(
        present.withColumnRenamed("feature", "column_name"), "column_name"
    )


@query(
    "P2_null_counts",
    f"WITH {T}, m AS (SELECT CASE WHEN txn_id % 97 <> 0 THEN V1 END AS V1, V2, Time, "
    "CASE WHEN txn_id % 89 <> 0 THEN Amount END AS Amount, Class FROM t) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT(*) - COUNT({c}) AS nulls FROM m"
        for c in ("V1", "V2", "Time", "Amount", "Class")
    )
    + " UNION ALL SELECT '(all)', 5*COUNT(*) - COUNT(V1) - COUNT(V2) - COUNT(Time) - COUNT(Amount) - COUNT(Class) FROM m",
)
def _(spark, sf):
    cols = ["V1", "V2", "Time", "Amount", "Class"]
    nulls = pr.null_counts(with_missing(transactions(spark, sf)), cols)
    total = nulls.agg(F.lit("(all)").alias("feature"), F.sum("nulls").alias("nulls"))
    return nulls.unionByName(total)


@query(
    "P3_class_balance",
    f"WITH {EV} SELECT COUNT(*) AS total, COUNT(*) FILTER (Class=1) AS positives, "
    "COUNT(*) FILTER (Class=0) AS negatives, "
    f"{R('AVG(Class)')} AS positive_rate, {R('100.0*SUM(Class)/COUNT(*)')} AS positive_pct, "
    f"{R('COUNT(*) FILTER (Class=0) * 1.0 / SUM(Class)')} AS imbalance FROM ev",
)
def _(spark, sf):
    return rounded(pr.class_balance(labelled_events(spark, sf)))


_DESC = (
    f"COUNT(value) AS n, {R('AVG(value)')} AS mean, {R('STDDEV_SAMP(value)')} AS std, "
    f"{R('MIN(value)')} AS min, {R('quantile_cont(value, 0.25)')} AS p25, "
    f"{R('quantile_cont(value, 0.5)')} AS p50, {R('quantile_cont(value, 0.75)')} AS p75, "
    f"{R('MAX(value)')} AS max"
)


@query("P4_describe", f"WITH {T}, {UT} SELECT feature, {_DESC} FROM u GROUP BY feature")
def _(spark, sf):
    return rounded(pr.describe(transactions(spark, sf), WIDE))


@query(
    "P5_describe_amount_by_class",
    f"WITH {EV} SELECT Class, {_DESC.replace('value', 'Amount')} FROM ev GROUP BY Class",
)
def _(spark, sf):
    return rounded(pr.describe_by_class(labelled_events(spark, sf), "Amount"))


@query(
    "P6_five_numbers_by_class",
    f"WITH {EV} SELECT Class, {R('MIN(Amount)')} AS p0, {R('quantile_cont(Amount,0.25)')} AS p25, "
    f"{R('quantile_cont(Amount,0.5)')} AS p50, {R('quantile_cont(Amount,0.75)')} AS p75, "
    f"{R('MAX(Amount)')} AS p100 FROM ev GROUP BY Class",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    q = exact_quantiles(
        df,
        {str(k): F.when(F.col("Class") == k, F.col("Amount")) for k in (0, 1)},
        [0.0, 0.25, 0.5, 0.75, 1.0],
    )
    return rounded(
        pr.small_frame(
            spark,
            [(int(k), *v) for k, v in q.items()],
            "Class int, p0 double, p25 double, p50 double, p75 double, p100 double",
        )
    )


@query(
    "P7_class_filter",
    f"WITH {EV} SELECT txn_id, user_id, {R('Amount')} AS Amount FROM ev WHERE Class = 1 AND Amount > 0",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    return df.where((F.col("Class") == 1) & (F.col("Amount") > 0)).select(
        "txn_id", "user_id", r6("Amount").alias("Amount")
    )


@query(
    "P8_target_correlation",
    f"WITH {T}, {UT} SELECT feature, {R('corr(value, Class)')} AS corr FROM u GROUP BY feature",
)
def _(spark, sf):
    return rounded(pr.target_correlation(transactions(spark, sf), WIDE))


@query(
    "P8_top_abs_correlation",
    f"WITH {T}, {UT}, c AS (SELECT feature, {R('corr(value, Class)')} AS corr FROM u GROUP BY feature) "
    "SELECT feature, corr FROM c ORDER BY ABS(corr) DESC, feature LIMIT 10",
)
def _(spark, sf):
    c = rounded(pr.target_correlation(transactions(spark, sf), WIDE))
    return c.orderBy(F.abs("corr").desc(), "feature").limit(10)


def _pairs_sql(cols, source):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {R(f'corr({a}, {b})') if a != b else 'CAST(MAX(1) AS DOUBLE)'} AS corr FROM {source}"
        for a in cols
        for b in cols
    )


@query(
    "P9_correlation_matrix",
    f"WITH {T}, m AS MATERIALIZED (SELECT {V_LIST}, Time, Amount FROM t) " + _pairs_sql(WIDE, "m"),
)
def _(spark, sf):
    return rounded(pr.correlation_pairs(transactions(spark, sf), WIDE))


@query("P9_top15_matrix")
def _(spark, sf):
    df = transactions(spark, sf)
    top = [
        r.feature
        for r in pr.target_correlation(df, WIDE)
        .orderBy(F.abs("corr").desc(), "feature").limit(15).collect()
    ]
    return rounded(pr.correlation_pairs(df, top))


def _hist_sql(cte, source, value, target, bins):
    b = f"LEAST({bins - 1}, floor(({value} - lo) / ((hi - lo) / {bins})))"
    return (
        f"WITH {cte}, b AS (SELECT MIN({value}) lo, MAX({value}) hi FROM {source}), "
        f"c AS (SELECT {target}, CAST({b} AS INT) AS bin, lo, hi, COUNT(*) AS n FROM {source}, b GROUP BY ALL) "
        f"SELECT {target}, bin, n, {R(f'n / (SUM(n) OVER (PARTITION BY {target}) * ((hi - lo) / {bins}))')} AS density FROM c"
    )


@query("P10_amount_histogram", _hist_sql(EV, "ev", "Amount", "Class", 50))
def _(spark, sf):
    return rounded(pr.histogram(labelled_events(spark, sf), "Amount", "Class"))


_HOUR = "floor(Time/3600.0) - 24*floor(Time/86400.0)"


@query(
    "P11_counts_by_hour_and_day",
    f"WITH {EV} SELECT 'hour' AS unit, CAST({_HOUR} AS INT) AS bucket, Class, COUNT(*) AS n FROM ev GROUP BY ALL "
    "UNION ALL SELECT 'day', CAST(floor(Time/86400.0) AS INT), Class, COUNT(*) FROM ev GROUP BY ALL",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    hour = (F.floor(F.col("Time") / 3600.0) - 24 * F.floor(F.col("Time") / 86400.0)).cast("int")
    day = F.floor(F.col("Time") / 86400.0).cast("int")
    both = F.inline(
        F.array(
            F.struct(F.lit("hour").alias("unit"), hour.alias("bucket")),
            F.struct(F.lit("day").alias("unit"), day.alias("bucket")),
        )
    )
    return df.select("Class", both).groupBy("unit", "bucket", "Class").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "P12_positive_rate_by_hour",
    f"WITH {EV} SELECT CAST({_HOUR} AS INT) AS hour, COUNT(*) AS n, {R('AVG(Class)')} AS positive_rate FROM ev GROUP BY ALL",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    hour = (F.floor(F.col("Time") / 3600.0) - 24 * F.floor(F.col("Time") / 86400.0)).cast("int")
    return df.groupBy(hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("Class")).alias("positive_rate")
    )


@query(
    "P13_dataset_summary",
    f"WITH {T} SELECT COUNT(*) AS total, {I('SUM(Class)')} AS positives, {R('AVG(Class)')} AS positive_rate, "
    f"{R('MIN(Amount)')} AS amount_min, {R('MAX(Amount)')} AS amount_max, {R('AVG(Amount)')} AS amount_mean, "
    f"{R('(MAX(Time)-MIN(Time))/3600.0')} AS span_hours, CAST(33 AS BIGINT) AS numeric_columns FROM t",
)
def _(spark, sf):
    return rounded(pr.dataset_summary(transactions(spark, sf)))


@query(
    "P14_feature_statistics",
    f"WITH {T}, {UT}, s AS (SELECT feature, AVG(value) mean, STDDEV_SAMP(value) std, MIN(value) mn, MAX(value) mx, "
    "quantile_cont(value, 0.5) median, COUNT(*) FILTER (value IS NULL) nulls, COUNT(DISTINCT value) dv, "
    "AVG(value) FILTER (Class=0) m0, AVG(value) FILTER (Class=1) m1 FROM u GROUP BY feature) "
    f"SELECT feature, {R('mean')} AS mean, {R('std')} AS std, {R('mn')} AS min, {R('mx')} AS max, "
    f"{R('median')} AS median, nulls, dv AS distinct_values, {R('m0')} AS class_0_mean, {R('m1')} AS class_1_mean, "
    f"{R('ABS(m1-m0)')} AS class_mean_diff, {R('ABS(m1-m0)/(ABS(m0)+1e-8)')} AS class_mean_diff_ratio FROM s",
)
def _(spark, sf):
    return rounded(pr.feature_statistics(transactions(spark, sf), WIDE))


@query(
    "P15_scatter_sample",
    f"WITH {T} SELECT txn_id, Class, {R('V1')} AS V1, {R('V2')} AS V2 FROM t WHERE Class=1 "
    f"UNION ALL (SELECT txn_id, Class, {R('V1')}, {R('V2')} FROM t WHERE Class=0 ORDER BY {pk_sql()}, txn_id LIMIT 10000)",
)
def _(spark, sf):
    df = pr.take_per_class(transactions(spark, sf), {1: None, 0: 10000})
    return rounded(df.select("txn_id", "Class", "V1", "V2"))


@query(
    "P16_compare_datasets",
    f"WITH {EV}, v AS (SELECT 'all' AS variant, Class FROM ev "
    "UNION ALL SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'reference' ELSE 'current' END, Class FROM ev) "
    f"SELECT variant, COUNT(*) AS n, {I('SUM(Class)')} AS positives, {I('SUM(1-Class)')} AS negatives, "
    f"{R('AVG(Class)')} AS positive_rate FROM v GROUP BY variant",
)
def _(spark, sf):
    df = labelled_events(spark, sf)
    side = F.when(
        F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'"), "reference"
    ).otherwise("current")
    long = df.select("Class", F.explode(F.array(F.lit("all"), side)).alias("variant"))
    return long.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("Class").alias("positives"),
        F.sum(1 - F.col("Class")).alias("negatives"),
        r6(F.avg("Class")).alias("positive_rate"),
    )


@query("P17_pca_projection")
def _(spark, sf):
    sample = permutation_sample(transactions(spark, sf), 10000)
    return project_components(sample, V_COLS, 2, ids=("txn_id", "Class"), standardize=True)


@query(
    "P18_first_rows",
    f"WITH {T} SELECT txn_id, {R('Time')} AS Time, {R('V1')} AS V1, {R('Amount')} AS Amount, Class FROM t ORDER BY Time, txn_id LIMIT 20",
)
def _(spark, sf):
    df = transactions(spark, sf).orderBy("Time", "txn_id").limit(20)
    return rounded(df.select("txn_id", "Time", "V1", "Amount", "Class"))


_BAND = (
    "CASE WHEN Amount < 50 THEN '0-50' WHEN Amount < 200 THEN '50-200' "
    "WHEN Amount < 1000 THEN '200-1000' ELSE '1000+' END"
)


@query(
    "P19_quality_by_amount_band",
    f"WITH {S}, b AS (SELECT {_BAND} AS band, COUNT(*) n, SUM(label) p, "
    "SUM(CASE WHEN score>=0.5 AND label=1 THEN 1 ELSE 0 END) tp, "
    "SUM(CASE WHEN score>=0.5 THEN 1 ELSE 0 END) pp FROM s GROUP BY ALL) "
    f"SELECT band, n, {I('p')} AS positives, {R('CASE WHEN pp=0 THEN 0 ELSE tp*1.0/pp END')} AS precision, "
    f"{R('CASE WHEN p=0 THEN 0 ELSE tp*1.0/p END')} AS recall, {R('CASE WHEN pp+p=0 THEN 0 ELSE 2.0*tp/(pp+p) END')} AS f1 FROM b",
)
def _(spark, sf):
    s = scored(spark, sf).withColumn("band", amount_band("Amount"))
    m = ev.basic_metrics(ev.confusion(ev.binarize(s, 0.5), by=["band"]))
    return rounded(
        m.select("band", "n", "positives", "precision", "recall", F.col("f1_score").alias("f1"))
    )


@query(
    "FLAGSHIP_class_hour_profile",
    f"WITH {T}, f AS (SELECT Class, CAST({_HOUR} AS INT) AS hour, Amount, ln(1+Amount) lg, "
    f"list_avg({V_ARRAY}) vm, list_aggregate({V_ARRAY}, 'stddev_samp') vs FROM t) "
    f"SELECT Class, hour, COUNT(*) AS n, {R('AVG(Amount)')} AS amount_mean, {R('AVG(lg)')} AS amount_log_mean, "
    f"{R('AVG(vm)')} AS v_mean, {R('AVG(vs)')} AS v_std FROM f GROUP BY ALL",
)
def _(spark, sf):
    wide = rowstats.add_row_statistics(transactions(spark, sf), V_COLS, ["V_mean", "V_std"])
    df = wide.select(
        "Class",
        F.floor(timeparts.hour_of_day("Time")).cast("int").alias("hour"),
        "Amount",
        F.log1p("Amount").alias("lg"),
        "V_mean",
        "V_std",
    )
    return rounded(
        df.groupBy("Class", "hour").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("Amount").alias("amount_mean"),
            F.avg("lg").alias("amount_log_mean"),
            F.avg("V_mean").alias("v_mean"),
            F.avg("V_std").alias("v_std"),
        )
    )
