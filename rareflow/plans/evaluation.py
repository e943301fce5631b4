"""Evaluation of scored rows (EV rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.operators import evaluation as ev
from rareflow.operators import profile as pr
from rareflow.operators.sampling import stratified_split
from rareflow.plans.catalog import EV, I, R, S, pk_sql, query, rounded, score_sql
from rareflow.sources.views import labelled_events, score_column, scored


def _cells(where="score >= 0.5", extra=""):
    return (
        f"SELECT {extra} SUM(CASE WHEN label=0 AND NOT ({where}) THEN 1 ELSE 0 END) AS tn, SUM(CASE WHEN label=0 AND {where} THEN 1 ELSE 0 END) AS fp, "
        f"SUM(CASE WHEN label=1 AND NOT ({where}) THEN 1 ELSE 0 END) AS fn, SUM(CASE WHEN label=1 AND {where} THEN 1 ELSE 0 END) AS tp FROM "
    )


def _ratio(a, b):
    return R(f"CASE WHEN ({b}) = 0 THEN 0 ELSE ({a})*1.0/({b}) END")


BASIC = (
    f"{_ratio('tp+tn', 'tn+fp+fn+tp')} AS accuracy, {_ratio('tp', 'tp+fp')} AS precision, {_ratio('tp', 'tp+fn')} AS recall, "
    f"{_ratio('2*tp', '2*tp+fp+fn')} AS f1_score, {_ratio('tn', 'tn+fp')} AS specificity"
)
COST = (
    f"{R('fp*1.0 + fn*10.0')} AS total_cost, {_ratio('fp*1.0 + fn*10.0', 'tn+fp+fn+tp')} AS avg_cost, "
    f"{_ratio('(fn+tp)*10.0 - fp*1.0 - fn*10.0', '(fn+tp)*10.0')} AS cost_reduction, {R('fp*1.0')} AS false_positive_cost, {R('fn*10.0')} AS false_negative_cost"
)
CM = f"cm AS ({_cells()} s)"
RUN = (
    "g AS (SELECT score, SUM(label) AS p, COUNT(*) AS n FROM s GROUP BY score), "
    "q AS (SELECT score, p, n, SUM(p) OVER w AS tp, SUM(n) OVER w AS k, SUM(p) OVER () AS pt, SUM(n) OVER () AS nt FROM g "
    "WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"
)
SWEEP = (
    "th AS (SELECT UNNEST(range(2, 20))/20.0 AS threshold), "
    f"sw AS ({_cells('score >= threshold', 'threshold,')} s, th GROUP BY threshold)"
)
AUC = "SUM(p*1.0*((nt-pt) - (k-tp) + (n-p)/2.0))/MAX(pt*1.0*(nt-pt))"
AP = "SUM(p*1.0/pt*tp/k)"


@query("EV1_binarize", f"WITH {S} SELECT txn_id, label, {R('score')} AS score, CASE WHEN score >= 0.8 THEN 1 ELSE 0 END AS pred FROM s")
def _(spark, sf):
    return rounded(ev.binarize(scored(spark, sf), 0.8).select("txn_id", "label", "score", "pred"))


@query(
    "EV2_confusion_matrix",
    f"WITH {S}, {CM} SELECT 0 AS label, 0 AS pred, {I('tn')} AS n, {_ratio('tn', 'tn+fp')} AS share FROM cm "
    f"UNION ALL SELECT 0, 1, {I('fp')}, {_ratio('fp', 'tn+fp')} FROM cm UNION ALL SELECT 1, 0, {I('fn')}, {_ratio('fn', 'fn+tp')} FROM cm "
    f"UNION ALL SELECT 1, 1, {I('tp')}, {_ratio('tp', 'fn+tp')} FROM cm",
)
def _(spark, sf):
    return rounded(ev.confusion_long(ev.binarize(scored(spark, sf))))


@query("EV3_basic_metrics", f"WITH {S}, {CM} SELECT {BASIC} FROM cm")
def _(spark, sf):
    m = ev.basic_metrics(ev.confusion(ev.binarize(scored(spark, sf))))
    return rounded(m.select("accuracy", "precision", "recall", "f1_score", "specificity"))


@query("EV4_cost_metrics", f"WITH {S}, {CM} SELECT {COST} FROM cm")
def _(spark, sf):
    m = ev.cost_metrics(ev.confusion(ev.binarize(scored(spark, sf))))
    return rounded(m.drop("tn", "fp", "fn", "tp"))


@query("EV5_threshold_sweep", f"WITH {S}, {SWEEP} SELECT {R('threshold')} AS threshold, {BASIC}, {COST} FROM sw")
def _(spark, sf):
    return rounded(ev.threshold_sweep(scored(spark, sf)).drop("tn", "fp", "fn", "tp", "n", "positives"))


@query(
    "EV6_roc_points",
    f"WITH {S}, {RUN} SELECT {R('score')} AS score, {R('(k-tp)*1.0/(nt-pt)')} AS fpr, {R('tp*1.0/pt')} AS tpr FROM q",
)
def _(spark, sf):
    return rounded(ev.curve_points(scored(spark, sf)).select("score", "fpr", "tpr"))


@query("EV7_roc_auc", f"WITH {S}, {RUN} SELECT {R(AUC)} AS roc_auc FROM q")
def _(spark, sf):
    return rounded(ev.roc_auc(scored(spark, sf)))


@query("EV8_average_precision", f"WITH {S}, {RUN} SELECT {R(AP)} AS average_precision FROM q")
def _(spark, sf):
    return rounded(ev.average_precision(scored(spark, sf)))


@query(
    "EV9_pr_auc_trapezoid",
    f"WITH {S}, {RUN}, z AS (SELECT score, tp*1.0/pt AS r, tp*1.0/k AS pr FROM q), "
    "l AS (SELECT r, pr, LAG(r, 1, 0) OVER (ORDER BY score DESC) AS r0, LAG(pr, 1, 1) OVER (ORDER BY score DESC) AS p0 FROM z) "
    f"SELECT {R('SUM((r-r0)*(pr+p0)/2.0)')} AS pr_auc_trapezoid FROM l",
)
def _(spark, sf):
    return rounded(ev.trapezoid_pr_auc(scored(spark, sf)))


@query(
    "EV10_pr_points",
    f"WITH {S}, {RUN} SELECT {R('score')} AS score, {R('tp*1.0/k')} AS precision, {R('tp*1.0/pt')} AS recall FROM q",
)
def _(spark, sf):
    return rounded(ev.curve_points(scored(spark, sf)).select("score", "precision", "recall"))


@query(
    "EV11_recall_at_fpr",
    f"WITH {S}, {RUN}, z AS (SELECT (k-tp)*1.0/(nt-pt) AS fpr, tp*1.0/pt AS tpr FROM q) "
    f"SELECT {R('COALESCE(MAX(tpr) FILTER (fpr <= 0.01), 0)')} AS recall_at_fpr_1pct, {R('COALESCE(MAX(tpr) FILTER (fpr <= 0.05), 0)')} AS recall_at_fpr_5pct FROM z",
)
def _(spark, sf):
    return rounded(ev.recall_at_fpr(scored(spark, sf)))


@query(
    "EV12_best_threshold",
    f"WITH {S}, {SWEEP}, m AS (SELECT {R('threshold')} AS threshold, {BASIC}, {COST} FROM sw) "
    "(SELECT 'f1_score' AS metric, threshold, f1_score AS value FROM m ORDER BY f1_score DESC, threshold LIMIT 1) UNION ALL "
    "(SELECT 'cost', threshold, total_cost FROM m ORDER BY total_cost, threshold LIMIT 1)",
)
def _(spark, sf):
    sweep = ev.threshold_sweep(scored(spark, sf))
    return rounded(ev.best_threshold(sweep, "f1_score").unionByName(ev.best_threshold(sweep, "cost")))


@query(
    "EV13_best_f1_point",
    f"WITH {S}, {RUN}, z AS (SELECT score, 2.0*tp/(k+pt) AS f1 FROM q) SELECT {R('score')} AS score, {R('f1')} AS f1 FROM z ORDER BY f1 DESC, score LIMIT 1",
)
def _(spark, sf):
    pts = ev.curve_points(scored(spark, sf)).select("score", "f1")
    return rounded(pts.orderBy(F.col("f1").desc(), "score").limit(1))


_P0, _R0, _F0 = "tn*1.0/(tn+fn)", "tn*1.0/(tn+fp)", "2.0*tn/(2*tn+fn+fp)"
_P1, _R1, _F1 = "tp*1.0/(tp+fp)", "tp*1.0/(tp+fn)", "2.0*tp/(2*tp+fn+fp)"
_N0, _N1, _NT = "(tn+fp)", "(tp+fn)", "(tn+fp+fn+tp)"


def _weighted(a, b):
    return f"({a}*{_N0} + {b}*{_N1})/{_NT}"


@query(
    "EV14_classification_report",
    f"WITH {S}, {CM} SELECT '0' AS class, {R(_P0)} AS precision, {R(_R0)} AS recall, {R(_F0)} AS f1_score, {I(_N0)} AS support FROM cm "
    f"UNION ALL SELECT '1', {R(_P1)}, {R(_R1)}, {R(_F1)}, {I(_N1)} FROM cm "
    f"UNION ALL SELECT 'macro avg', {R(f'({_P0}+{_P1})/2')}, {R(f'({_R0}+{_R1})/2')}, {R(f'({_F0}+{_F1})/2')}, {I(_NT)} FROM cm "
    f"UNION ALL SELECT 'weighted avg', {R(_weighted(_P0, _P1))}, {R(_weighted(_R0, _R1))}, {R(_weighted(_F0, _F1))}, {I(_NT)} FROM cm "
    f"UNION ALL SELECT 'accuracy', {R(f'(tp+tn)*1.0/{_NT}')}, {R(f'(tp+tn)*1.0/{_NT}')}, {R(f'(tp+tn)*1.0/{_NT}')}, {I(_NT)} FROM cm",
)
def _(spark, sf):
    return rounded(ev.classification_report(ev.binarize(scored(spark, sf))))


@query(
    "EV15_full_evaluation",
    f"WITH {S}, {CM}, {RUN}, {SWEEP}, m AS (SELECT {R('threshold')} AS threshold, {BASIC}, {COST} FROM sw), "
    f"a AS (SELECT {R(AUC)} AS roc_auc, {R(AP)} AS pr_auc FROM q), "
    f"f AS (SELECT {R('COALESCE(MAX(tp*1.0/pt) FILTER ((k-tp)*1.0/(nt-pt) <= 0.01), 0)')} AS recall_at_fpr_1pct FROM q) "
    f"SELECT {BASIC}, {COST}, a.roc_auc, a.pr_auc, f.recall_at_fpr_1pct, (SELECT threshold FROM m ORDER BY f1_score DESC, threshold LIMIT 1) AS best_f1_threshold, "
    "(SELECT threshold FROM m ORDER BY total_cost, threshold LIMIT 1) AS best_cost_threshold FROM cm, a, f",
)
def _(spark, sf):
    return rounded(ev.full_evaluation(scored(spark, sf)))


_SPLIT = (
    f"o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {pk_sql()}, txn_id) - 1 AS rn, COUNT(*) OVER (PARTITION BY label) AS n FROM s), "
    "sp AS (SELECT label, score, CASE WHEN rn < CAST(floor(n*0.6 + 1e-9) AS BIGINT) THEN 'train' WHEN rn < CAST(floor(n*0.6 + 1e-9) AS BIGINT) + CAST(floor(n*0.2 + 1e-9) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM o)"
)


def _grouped_run(by, source):
    return (
        f"g AS (SELECT {by}, score, SUM(label) AS p, COUNT(*) AS n FROM {source} GROUP BY {by}, score), "
        f"q AS (SELECT {by}, score, p, n, SUM(p) OVER w AS tp, SUM(n) OVER w AS k, SUM(p) OVER (PARTITION BY {by}) AS pt, SUM(n) OVER (PARTITION BY {by}) AS nt FROM g "
        f"WINDOW w AS (PARTITION BY {by} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), "
        f"a AS (SELECT {by}, {R(AUC)} AS roc_auc, {R(AP)} AS pr_auc FROM q GROUP BY {by}), "
        f"cm AS ({_cells(extra=f'{by},')} {source} GROUP BY {by})"
    )


@query(
    "EV16_metrics_per_split",
    f"WITH {S}, {_SPLIT}, {_grouped_run('split', 'sp')} SELECT split, {I('tn+fp+fn+tp')} AS n, {BASIC}, roc_auc, pr_auc FROM cm JOIN a USING (split)",
)
def _(spark, sf):
    df = stratified_split(
        scored(spark, sf), (("train", 0.6), ("validation", 0.2), ("test", 0.2)), target="label"
    )
    m = ev.all_metrics(df, by=["split"])
    return rounded(
        m.select("split", "n", "accuracy", "precision", "recall", "f1_score", "specificity", "roc_auc", "pr_auc")
    )


MULTIPLIERS = (7919, 7907, 7901)
_MODELS = "ms AS (" + " UNION ALL ".join(
    f"SELECT 'm{m}' AS model, Class AS label, {score_sql(m)} AS score FROM ev" for m in MULTIPLIERS
) + ")"


def model_scores(spark, sf):
    """One scored row per (transaction, model)."""
    df = labelled_events(spark, sf)
    rows = F.array(
        *[F.struct(F.lit(f"m{m}").alias("model"), score_column(m).alias("score")) for m in MULTIPLIERS]
    )
    return df.select("txn_id", F.col("Class").alias("label"), F.inline(rows))


@query(
    "EV17_compare_models",
    f"WITH {EV}, {_MODELS}, {_grouped_run('model', 'ms')} SELECT model, {BASIC}, roc_auc, pr_auc FROM cm JOIN a USING (model)",
)
def _(spark, sf):
    m = ev.all_metrics(model_scores(spark, sf), by=["model"])
    return rounded(
        m.select("model", "accuracy", "precision", "recall", "f1_score", "specificity", "roc_auc", "pr_auc")
    )


@query(
    "EV17_best_model_per_metric",
    f"WITH {EV}, {_MODELS}, {_grouped_run('model', 'ms')}, m AS (SELECT model, {BASIC}, roc_auc, pr_auc FROM cm JOIN a USING (model)), "
    "l AS (UNPIVOT (SELECT model, accuracy, precision, recall, f1_score, roc_auc, pr_auc FROM m) ON accuracy, precision, recall, f1_score, roc_auc, pr_auc INTO NAME metric VALUE value) "
    "SELECT metric, model, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY value DESC, model) AS rn FROM l) WHERE rn = 1",
)
def _(spark, sf):
    m = rounded(ev.all_metrics(model_scores(spark, sf), by=["model"]))
    return ev.best_per_metric(ev.metrics_long(m, by=["model"])).select("metric", "model", "value")


@query(
    "EV18_score_histogram",
    f"WITH {S}, b AS (SELECT MIN(score) lo, MAX(score) hi FROM s), c AS (SELECT label, CAST(LEAST(49, floor((score-lo)/((hi-lo)/50))) AS INT) AS bin, lo, hi, COUNT(*) AS n FROM s, b GROUP BY ALL) "
    f"SELECT label, bin, n, {R('n/(SUM(n) OVER (PARTITION BY label)*((hi-lo)/50))')} AS density FROM c",
)
def _(spark, sf):
    return rounded(pr.histogram(scored(spark, sf), "score", "label"))


@query("EV19_baseline_rate", f"WITH {S} SELECT {R('AVG(label)')} AS baseline, COUNT(*) AS n FROM s")
def _(spark, sf):
    return rounded(scored(spark, sf).agg(F.avg("label").alias("baseline"), F.count(F.lit(1)).alias("n")))


@query(
    "EV20_business_impact",
    f"WITH {S}, b AS (SELECT SUM(Amount) FILTER (label=1) AS pa, SUM(Amount) FILTER (label=1 AND score>=0.5) AS ca, SUM(Amount) FILTER (label=1 AND score<0.5) AS ma, "
    "COUNT(*) FILTER (label=0 AND score>=0.5) AS fa FROM s) "
    f"SELECT {R('pa')} AS positive_amount, {R('ca')} AS caught_amount, {R('ma')} AS missed_amount, fa AS false_alarms, {R('ca - 1.0*fa - ma')} AS net_benefit FROM b",
)
def _(spark, sf):
    return rounded(ev.business_impact(scored(spark, sf)))


@query(
    "EV21_youden_threshold",
    f"WITH {S}, {RUN}, z AS (SELECT score, tp*1.0/pt AS tpr, (k-tp)*1.0/(nt-pt) AS fpr FROM q) "
    f"SELECT {R('score')} AS score, {R('tpr')} AS tpr, {R('fpr')} AS fpr FROM z ORDER BY {R('tpr-fpr')} DESC, score LIMIT 1",
)
def _(spark, sf):
    pts = ev.curve_points(scored(spark, sf)).select("score", "tpr", "fpr")
    return rounded(pts.orderBy(F.round(F.col("tpr") - F.col("fpr"), 6).desc(), "score").limit(1))
