"""Drift and performance monitoring (D and PM rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions.bands import drift_severity
from rareflow.functions.keys import normal_draw
from rareflow.functions.shape import V_COLS
from rareflow.operators import drift, monitoring
from rareflow.operators import evaluation as ev
from rareflow.plans.catalog import EV, R, S, T, normal_sql, query, r6, rounded
from rareflow.sources.views import (
    labelled_events,
    reference_and_current,
    scored,
    transactions,
    with_drift,
)

# Monitored features and baseline metrics.
MONITORED = ["V1", "V2", "V3", "V4", "V5", "V10", "V14", "V17", "Amount"]
BASELINE = {"accuracy": 0.999, "precision": 0.864, "recall": 0.901, "f1_score": 0.882, "roc_auc": 0.987, "pr_auc": 0.842}
CUT = "TIMESTAMP '2024-01-16'"

_DRIFTED = ", ".join(
    {"V1": "V1*1.1+0.1 AS V1", "V2": "V2*0.9-0.2 AS V2"}.get(c, c) for c in MONITORED
)
_LIST = ", ".join(MONITORED)
# the reference half, and the current half with known drift
BOTH = (
    f"{T}, r AS (SELECT {_LIST} FROM t WHERE ts < {CUT}), c AS (SELECT {_DRIFTED} FROM t WHERE ts >= {CUT}), "
    f"z AS (SELECT 0 AS side, {_LIST} FROM r UNION ALL SELECT 1 AS side, {_LIST} FROM c), "
    f"u AS (UNPIVOT z ON {_LIST} INTO NAME feature VALUE value), "
    "n AS (SELECT feature, COUNT(*) FILTER (side=0) AS nr, COUNT(*) FILTER (side=1) AS nc FROM u GROUP BY feature)"
)
SHIFT = (
    "sh AS (SELECT feature, AVG(value) FILTER (side=0) AS ref_mean, AVG(value) FILTER (side=1) AS cur_mean, "
    "STDDEV_SAMP(value) FILTER (side=0) AS ref_std, STDDEV_SAMP(value) FILTER (side=1) AS cur_std FROM u GROUP BY feature)"
)
BINNED = (
    "b AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi, LEAST(10, COUNT(DISTINCT value)) AS k FROM u GROUP BY feature), "
    "w AS (SELECT u.feature, u.side, CAST(LEAST(k-1, floor((value-lo)/((hi-lo)/k))) AS INT) AS bin FROM u JOIN b USING (feature)), "
    "sr AS (SELECT w.feature, bin, GREATEST(COUNT(*) FILTER (side=0)*1.0/MAX(nr), 1e-10) AS r, GREATEST(COUNT(*) FILTER (side=1)*1.0/MAX(nc), 1e-10) AS c "
    "FROM w JOIN n USING (feature) GROUP BY w.feature, bin)"
)
PSI = "psi AS (SELECT feature, SUM((c-r)*ln(c/r)) AS psi FROM sr GROUP BY feature)"
KS = (
    "g AS (SELECT feature, value, SUM(1-side) AS r, SUM(side) AS c FROM u GROUP BY feature, value), "
    "gr AS (SELECT feature, SUM(r) OVER w AS cr, SUM(c) OVER w AS cc FROM g WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)), "
    "kd AS (SELECT gr.feature, MAX(ABS(cr*1.0/nr - cc*1.0/nc)) AS ks_stat, MAX(nr) AS nr, MAX(nc) AS nc FROM gr JOIN n USING (feature) GROUP BY gr.feature), "
    "kx AS (SELECT feature, ks_stat, ks_stat*sqrt(nr*1.0*nc/(nr+nc)) AS x FROM kd), "
    "ks AS (SELECT feature, ks_stat, CASE WHEN x < 0.2 THEN 1.0 ELSE LEAST(1.0, GREATEST(0.0, "
    "list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k%2=1 THEN 2.0 ELSE -2.0 END)*exp(-2.0*k*k*x*x))))) END AS ks_p_value FROM kx)"
)
SEVERITY = "CASE WHEN psi > 0.25 THEN 'Major drift' WHEN psi > 0.1 THEN 'Minor drift' ELSE 'No drift' END"


def _sides(spark, sf):
    ref, cur = reference_and_current(transactions(spark, sf))
    return ref, with_drift(cur)


@query(
    "D1_mean_std_shift",
    f"WITH {BOTH}, {SHIFT} SELECT feature, {R('ref_mean')} AS ref_mean, {R('ref_std')} AS ref_std, {R('cur_mean')} AS cur_mean, {R('cur_std')} AS cur_std, "
    f"ROUND(ABS(cur_mean-ref_mean)/(ABS(ref_mean)+1e-10)*100, 4) + CAST(0 AS DOUBLE) AS mean_diff_pct, {R('ABS(cur_std-ref_std)/(ABS(ref_std)+1e-10)*100')} AS std_diff_pct FROM sh",
)
def _(spark, sf):
    out = drift.mean_std_shift(*_sides(spark, sf), MONITORED)
    pct = F.round("mean_diff_pct", 4) + F.lit(0.0)
    return rounded(out.drop("mean_diff_pct")).join(
        out.select("feature", pct.alias("mean_diff_pct")), "feature"
    )


@query("D2_psi_equal_width", f"WITH {BOTH}, {BINNED}, {PSI} SELECT feature, {R('psi')} AS psi FROM psi")
def _(spark, sf):
    return rounded(drift.psi_equal_width(*_sides(spark, sf), MONITORED))


_EDGES = ", ".join(f"quantile_cont(value, {i / 10})" for i in range(1, 10))


@query(
    "D3_psi_deciles",
    f"WITH {BOTH}, e AS (SELECT feature, list_distinct([{_EDGES}]) AS edges FROM u WHERE side=0 GROUP BY feature), "
    "w AS (SELECT u.feature, side, len(list_filter(edges, lambda x: x < value)) AS bin FROM u JOIN e USING (feature)), "
    "sr AS (SELECT w.feature, bin, GREATEST(COUNT(*) FILTER (side=0)*1.0/MAX(nr), 1e-10) AS r, GREATEST(COUNT(*) FILTER (side=1)*1.0/MAX(nc), 1e-10) AS c "
    f"FROM w JOIN n USING (feature) GROUP BY w.feature, bin), {PSI} SELECT feature, {R('psi')} AS psi FROM psi",
)
def _(spark, sf):
    return rounded(drift.psi_deciles(*_sides(spark, sf), MONITORED))


@query(
    "D4_psi_categorical",
    f"WITH {EV}, g AS (SELECT event_type, COUNT(*) FILTER (ts < {CUT}) AS a, COUNT(*) FILTER (ts >= {CUT}) AS b FROM ev WHERE NOT (event_type='view' AND ts < {CUT}) GROUP BY 1), "
    "s AS (SELECT GREATEST(a*1.0/SUM(a) OVER (), 1e-10) AS r, GREATEST(b*1.0/SUM(b) OVER (), 1e-10) AS c FROM g) "
    f"SELECT 'event_type' AS feature, {R('SUM((c-r)*ln(c/r))')} AS psi FROM s",
)
def _(spark, sf):
    ref, cur = reference_and_current(labelled_events(spark, sf))
    ref = ref.where(F.col("event_type") != "view")
    return rounded(drift.psi_categorical(ref, cur, "event_type"))


@query(
    "D5_ks_two_sample",
    f"WITH {BOTH}, {KS} SELECT feature, {R('ks_stat')} AS ks_stat, {R('ks_p_value')} AS ks_p_value, ks_p_value < 0.05 AS drift_detected_ks FROM ks",
)
def _(spark, sf):
    return rounded(drift.ks_two_sample(*_sides(spark, sf), MONITORED))


@query("D6_drift_severity", f"WITH {BOTH}, {BINNED}, {PSI} SELECT feature, {SEVERITY} AS severity FROM psi")
def _(spark, sf):
    psi = drift.psi_equal_width(*_sides(spark, sf), MONITORED)
    return psi.select("feature", drift_severity("psi").alias("severity"))


_REPORT = (
    f"WITH {BOTH}, {SHIFT}, {BINNED}, {PSI}, {KS}, rep AS (SELECT feature, ref_mean, cur_mean, ref_std, cur_std, psi, {SEVERITY} AS drift_severity_psi, ks_stat, ks_p_value, "
    "ks_p_value < 0.05 AS drift_detected_ks FROM sh JOIN psi USING (feature) JOIN ks USING (feature))"
)


@query(
    "D7_drift_report",
    _REPORT
    + f" SELECT feature, {R('ref_mean')} AS ref_mean, {R('cur_mean')} AS cur_mean, {R('ref_std')} AS ref_std, {R('cur_std')} AS cur_std, {R('psi')} AS psi, "
    f"drift_severity_psi, {R('ks_stat')} AS ks_stat, {R('ks_p_value')} AS ks_p_value, drift_detected_ks FROM rep",
)
def _(spark, sf):
    report = drift.drift_report(*_sides(spark, sf), MONITORED)
    return rounded(report.drop("mean_diff_pct", "std_diff_pct"))


@query("D7_drift_report_all_columns")
def _(spark, sf):
    ref, cur = reference_and_current(transactions(spark, sf))
    return rounded(drift.drift_report(ref, cur))


@query(
    "D8_top_drifted",
    f"WITH {BOTH}, {BINNED}, {PSI} SELECT feature, {R('psi')} AS psi FROM psi ORDER BY psi DESC, feature LIMIT 5",
)
def _(spark, sf):
    psi = drift.psi_equal_width(*_sides(spark, sf), MONITORED)
    return rounded(psi.orderBy(F.col("psi").desc(), "feature").limit(5))


@query(
    "D9_injected_drift",
    f"WITH {T} SELECT txn_id, {R('V1*1.1+0.1')} AS V1, {R('V2*0.9-0.2')} AS V2, {R('V3')} AS V3 FROM t",
)
def _(spark, sf):
    return rounded(with_drift(transactions(spark, sf)).select("txn_id", "V1", "V2", "V3"))


@query(
    "D9_injected_noise",
    f"WITH {T} SELECT txn_id, {R('V1*1.1+0.1')} AS V1, {R('V2*0.9-0.2')} AS V2, {R('V3')} AS V3, "
    f"{R('V3 + 0.2*' + normal_sql('txn_id', 42))} AS V3_noisy FROM t",
)
def _(spark, sf):
    df = with_drift(transactions(spark, sf))
    noisy = df.withColumn("V3_noisy", F.col("V3") + F.lit(0.2) * normal_draw("txn_id", 42))
    return rounded(noisy.select("txn_id", "V1", "V2", "V3", "V3_noisy"))


@query(
    "Q10_dataset_drift",
    _REPORT
    + " SELECT bool_or(drift_severity_psi <> 'No drift' OR drift_detected_ks) AS drift_detected, COUNT(*) AS features_checked, "
    "array_to_string(list_sort(list(feature) FILTER (drift_severity_psi <> 'No drift' OR drift_detected_ks)), ',') AS drifted_features FROM rep",
)
def _(spark, sf):
    return drift.drift_verdict(drift.drift_report(*_sides(spark, sf), MONITORED))


# ---- performance monitoring --------------------------------------------------

_METRICS = (
    f"{S}, cm AS (SELECT SUM(CASE WHEN label=0 AND score<0.5 THEN 1 ELSE 0 END) tn, SUM(CASE WHEN label=0 AND score>=0.5 THEN 1 ELSE 0 END) fp, "
    "SUM(CASE WHEN label=1 AND score<0.5 THEN 1 ELSE 0 END) fn, SUM(CASE WHEN label=1 AND score>=0.5 THEN 1 ELSE 0 END) tp FROM s), "
    "g AS (SELECT score, SUM(label) p, COUNT(*) n FROM s GROUP BY score), "
    "q AS (SELECT score, p, n, SUM(p) OVER w AS tp, SUM(n) OVER w AS k, SUM(p) OVER () AS pt, SUM(n) OVER () AS nt FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), "
    "ar AS (SELECT SUM(p*1.0*((nt-pt) - (k-tp) + (n-p)/2.0))/MAX(pt*1.0*(nt-pt)) AS roc_auc, SUM(p*1.0/pt*tp/k) AS pr_auc FROM q), "
    "cur AS (SELECT 'accuracy' AS metric, (tp+tn)*1.0/(tn+fp+fn+tp) AS current FROM cm UNION ALL SELECT 'precision', tp*1.0/(tp+fp) FROM cm "
    "UNION ALL SELECT 'recall', tp*1.0/(tp+fn) FROM cm UNION ALL SELECT 'f1_score', 2.0*tp/(2*tp+fp+fn) FROM cm "
    "UNION ALL SELECT 'roc_auc', roc_auc FROM ar UNION ALL SELECT 'pr_auc', pr_auc FROM ar)"
)


def _base_sql(names):
    return "base(metric, baseline) AS (VALUES " + ", ".join(f"('{m}', {BASELINE[m]})" for m in names) + ")"


_CMP = (
    f"WITH {_METRICS}, {_base_sql(BASELINE)}, d AS (SELECT metric, baseline, current, (baseline-current)/baseline*100 AS pct FROM cur JOIN base USING (metric)), "
    "cmp AS (SELECT *, CASE WHEN pct > 10 THEN 'CRITICAL' WHEN pct > 5 THEN 'WARNING' ELSE 'OK' END AS status FROM d)"
)


def _comparison(spark, sf, names=tuple(BASELINE)):
    current = ev.metrics_long(ev.all_metrics(scored(spark, sf)))
    return monitoring.compare_with_baseline(current, {m: BASELINE[m] for m in names})


@query(
    "PM1_baseline_comparison",
    _CMP + f" SELECT metric, {R('baseline')} AS baseline, {R('current')} AS current, {R('pct')} AS degradation_pct, status FROM cmp",
)
def _(spark, sf):
    return rounded(_comparison(spark, sf))


@query(
    "PM2_metrics_without_baseline",
    f"WITH {_METRICS}, {_base_sql(['precision', 'recall', 'f1_score'])} SELECT metric, {R('current')} AS current FROM cur ANTI JOIN base USING (metric)",
)
def _(spark, sf):
    current = ev.metrics_long(ev.all_metrics(scored(spark, sf)))
    some = {m: BASELINE[m] for m in ("precision", "recall", "f1_score")}
    return rounded(monitoring.without_baseline(current, some).withColumnRenamed("value", "current"))


@query(
    "PM3_alerts",
    _CMP + " SELECT metric, status, metric || ': ' || status AS alert FROM cmp WHERE status <> 'OK'",
)
def _(spark, sf):
    return monitoring.alerts(_comparison(spark, sf))


@query(
    "PM4_run_summary",
    _REPORT
    + ", " + _METRICS.split(f"{EV}, ", 1)[1].replace("g AS", "sg AS").replace("FROM g ", "FROM sg ")
    + " SELECT COUNT(*) AS features_monitored, COUNT(*) FILTER (drift_severity_psi <> 'No drift') AS features_with_drift, "
    "COUNT(*) FILTER (drift_severity_psi = 'Major drift') AS major_drift_features, arg_max(feature, psi) AS top_drifted_feature, "
    + R("(SELECT current FROM cur WHERE metric='pr_auc')") + " AS current_pr_auc, CAST(0.842 AS DOUBLE) AS baseline_pr_auc, "
    + R("(SELECT current FROM cur WHERE metric='f1_score')") + " AS current_f1, CAST(0.882 AS DOUBLE) AS baseline_f1 FROM rep",
)
def _(spark, sf):
    report = drift.drift_report(*_sides(spark, sf), MONITORED)
    return rounded(monitoring.run_summary(report, _comparison(spark, sf)))


@query(
    "PM5_floor_alerts",
    f"WITH {_METRICS}, lat AS (SELECT quantile_cont(Amount, 0.95) AS v FROM ev), er AS (SELECT AVG(CASE WHEN event_type='error' THEN 1.0 ELSE 0.0 END) AS v FROM ev), "
    "obs AS (SELECT metric, current AS value FROM cur UNION ALL SELECT 'latency_p95_ms', v FROM lat UNION ALL SELECT 'error_rate', v FROM er), "
    "rules(metric, kind, bound) AS (VALUES ('precision','min',0.8),('recall','min',0.75),('latency_p95_ms','max',200.0),('error_rate','max',0.01)) "
    f"SELECT metric, {R('value')} AS value, {R('bound')} AS bound, CASE WHEN kind='min' THEN value < bound ELSE value > bound END AS alert FROM obs JOIN rules USING (metric)",
)
def _(spark, sf):
    events = labelled_events(spark, sf)
    observed = ev.metrics_long(ev.all_metrics(scored(spark, sf))).unionByName(
        monitoring.service_metrics(events, latency="Amount", failed=F.col("event_type") == "error")
    )
    return rounded(monitoring.floor_alerts(observed))


@query(
    "PM6_score_drift",
    f"WITH {S}, z AS (SELECT CASE WHEN ts < {CUT} THEN 0 ELSE 1 END AS side, 'score' AS feature, score AS value FROM s), "
    "u AS (SELECT * FROM z), n AS (SELECT feature, COUNT(*) FILTER (side=0) AS nr, COUNT(*) FILTER (side=1) AS nc FROM u GROUP BY feature), "
    f"{BINNED}, {PSI}, {KS} SELECT feature, {R('psi')} AS psi, {R('ks_stat')} AS ks_stat FROM psi JOIN ks USING (feature)",
)
def _(spark, sf):
    ref, cur = reference_and_current(scored(spark, sf))
    psi = drift.psi_equal_width(ref, cur, ["score"])
    return rounded(psi.join(drift.ks_two_sample(ref, cur, ["score"]), "feature").select("feature", "psi", "ks_stat"))


_WEEKLY = [*V_COLS, "Amount"]
_WEEKLY_SQL = ", ".join(_WEEKLY)


@query(
    "PM6_weekly_drift",
    f"WITH {T}, z AS (SELECT CASE WHEN ts < {CUT} THEN -1 ELSE CAST(floor(Time/604800.0) AS INT) END AS week, {_WEEKLY_SQL} FROM t), "
    f"u AS (UNPIVOT z ON {_WEEKLY_SQL} INTO NAME feature VALUE value), "
    "b AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi, LEAST(10, COUNT(DISTINCT value)) AS k FROM u GROUP BY feature), "
    "w AS (SELECT week, u.feature, CAST(LEAST(k-1, floor((value-lo)/((hi-lo)/k))) AS INT) AS bin FROM u JOIN b USING (feature)), "
    "nw AS (SELECT week, COUNT(*) AS n FROM z GROUP BY week), "
    "grid AS (SELECT nw.week, b.feature, i.bin, nw.n FROM nw, b, (SELECT UNNEST(range(0,10)) AS bin) i WHERE nw.week >= 0), "
    "cn AS (SELECT week, feature, bin, COUNT(*) AS c FROM w GROUP BY ALL), "
    "sh AS (SELECT g.week, g.feature, GREATEST(COALESCE(a.c,0)*1.0/g.n, 1e-10) AS c, GREATEST(COALESCE(r.c,0)*1.0/(SELECT n FROM nw WHERE week=-1), 1e-10) AS r "
    "FROM grid g LEFT JOIN cn a ON a.week=g.week AND a.feature=g.feature AND a.bin=g.bin LEFT JOIN cn r ON r.week=-1 AND r.feature=g.feature AND r.bin=g.bin) "
    f"SELECT week, feature, {R('SUM((c-r)*ln(c/r))')} AS psi FROM sh GROUP BY week, feature",
)
def _(spark, sf):
    ref, cur = reference_and_current(transactions(spark, sf))
    week = F.floor(F.col("Time") / 604800.0).cast("int")
    return rounded(drift.grouped_psi(ref, cur.withColumn("week", week), _WEEKLY, "week"))


@query(
    "PM7_js_distance",
    f"WITH {BOTH}, {BINNED}, j AS (SELECT feature, sqrt(SUM((r*ln(r/((r+c)/2.0)) + c*ln(c/((r+c)/2.0)))/2.0)) AS js FROM sr GROUP BY feature) "
    f"SELECT feature, {R('js')} AS js_distance, js > 0.12 AS drifted FROM j",
)
def _(spark, sf):
    shares = drift.binned_shares(*_sides(spark, sf), MONITORED)
    out = shares.groupBy("feature").agg(drift.js_distance().alias("js"))
    return out.select("feature", r6("js").alias("js_distance"), (F.col("js") > 0.12).alias("drifted"))
