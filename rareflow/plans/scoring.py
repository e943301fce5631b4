"""Batch scoring, feedback and registry (B and R rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareflow.functions.shape import V_COLS
from rareflow.operators import evaluation as ev
from rareflow.operators import models as md
from rareflow.operators import registry as rg
from rareflow.operators import scaling
from rareflow.operators import scoring as sc
from rareflow.operators.sampling import stratified_split
from rareflow.plans.catalog import EV, R, S, query, rounded, score_sql
from rareflow.plans.evaluation import AP, AUC, MULTIPLIERS, model_scores
from rareflow.sources.views import labelled_events, score_column, transactions, scored

COLS = [*V_COLS, "Amount"]


def predictions(spark, sf):
    """Scored events of two model versions as stored predictions."""
    df = labelled_events(spark, sf).withColumn("score", score_column())
    version = F.when(F.col("txn_id") % 2 == 0, "v1").otherwise("v2")
    return sc.as_predictions(ev.binarize(df).withColumn("model_version", version))


PRED = (
    f"{EV}, p AS (SELECT CAST(txn_id AS VARCHAR) AS transaction_id, txn_id, Class, Amount, Time, {score_sql()} AS prediction_score, "
    f"CASE WHEN {score_sql()} >= 0.5 THEN 1 ELSE 0 END AS prediction_label, CASE WHEN txn_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version, ts AS created_at FROM ev)"
)


@query("B1_score_table")
def _(spark, sf):
    df = transactions(spark, sf)
    split = stratified_split(df, (("train", 0.8), ("test", 0.2)))
    train = split.where("split = 'train'").drop("split")
    model = md.fit(train, COLS, md.logistic(1.0, n=train.count()))
    out = md.probability(df, model).select("txn_id", "score")
    return sc.with_bands(out)


_CONF = "CASE WHEN score >= 0.8 OR score <= 0.2 THEN 'high' WHEN score >= 0.6 OR score <= 0.4 THEN 'medium' ELSE 'low' END"
_RISK = "CASE WHEN score > 0.8 THEN 'HIGH' WHEN score > 0.5 THEN 'MEDIUM' ELSE 'LOW' END"


@query("B2_confidence", f"WITH {S} SELECT txn_id, {_CONF} AS confidence FROM s")
def _(spark, sf):
    return sc.with_bands(scored(spark, sf)).select("txn_id", "confidence")


@query("B3_risk_level", f"WITH {S} SELECT txn_id, {R('score*100.0')} AS risk_score, {_RISK} AS risk_level FROM s")
def _(spark, sf):
    return rounded(sc.with_bands(scored(spark, sf)).select("txn_id", "risk_score", "risk_level"))


@query(
    "B4_batch_summary",
    f"WITH {S} SELECT COUNT(*) AS total, COUNT(*) FILTER (score >= 0.5) AS flagged, {R('AVG(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END)')} AS flagged_rate FROM s",
)
def _(spark, sf):
    return rounded(sc.batch_summary(sc.with_bands(scored(spark, sf))))


@query("B5_aligned_scoring")
def _(spark, sf):
    df = transactions(spark, sf)
    aligned = scaling.align_to_schema(df, keep=["txn_id", "Class"])
    usable = [n for n in scaling.SCHEMA_50 if n in V_COLS or "_" in n]
    train = stratified_split(aligned, (("train", 0.8), ("test", 0.2))).where("split = 'train'").drop("split")
    params = scaling.fit_standard(train, usable)
    model = md.fit(scaling.apply_scaler(train, params), usable, md.logistic(1.0, n=train.count()))
    out = md.probability(scaling.apply_scaler(aligned, params), model).select("txn_id", "score")
    return sc.with_bands(out)


@query(
    "B6_outcome_counts",
    f"WITH {PRED}, sp AS (SELECT model_version, date_diff('microsecond', MIN(created_at), MAX(created_at))/1000000.0 AS s FROM p GROUP BY 1) "
    f"SELECT p.model_version, prediction_label, COUNT(*) AS n, {R('COUNT(*)/MAX(sp.s)')} AS per_second FROM p JOIN sp USING (model_version) GROUP BY 1, 2",
)
def _(spark, sf):
    return rounded(sc.outcome_counts(predictions(spark, sf)))


def feedback(spark, sf):
    """Two label reports for every third transaction: the first one wrong for some."""
    df = labelled_events(spark, sf).where(F.col("txn_id") % 3 == 0)
    first = F.when(F.col("txn_id") % 6 == 0, 1 - F.col("Class")).otherwise(F.col("Class"))
    reports = F.array(
        F.struct(first.alias("feedback_label"), F.expr("ts + INTERVAL 1 DAY").alias("feedback_at")),
        F.struct(F.col("Class").alias("feedback_label"), F.expr("ts + INTERVAL 2 DAY").alias("feedback_at")),
    )
    return df.select(F.col("txn_id").cast("string").alias("transaction_id"), F.inline(reports))


@query(
    "B7_feedback_metrics",
    f"WITH {PRED}, l AS (SELECT model_version, Class AS label, prediction_label AS pred FROM p WHERE txn_id % 3 = 0), "
    "c AS (SELECT model_version, COUNT(*) AS n, SUM(CASE WHEN label=1 AND pred=1 THEN 1 ELSE 0 END) tp, SUM(CASE WHEN label=0 AND pred=1 THEN 1 ELSE 0 END) fp, "
    "SUM(CASE WHEN label=1 AND pred=0 THEN 1 ELSE 0 END) fn, SUM(CASE WHEN label=0 AND pred=0 THEN 1 ELSE 0 END) tn FROM l GROUP BY 1) "
    f"SELECT model_version, n, {R('(tp+tn)*1.0/n')} AS accuracy, {R('CASE WHEN tp+fp=0 THEN 0 ELSE tp*1.0/(tp+fp) END')} AS precision, "
    f"{R('CASE WHEN tp+fn=0 THEN 0 ELSE tp*1.0/(tp+fn) END')} AS recall, {R('CASE WHEN 2*tp+fp+fn=0 THEN 0 ELSE 2.0*tp/(2*tp+fp+fn) END')} AS f1_score FROM c",
)
def _(spark, sf):
    attached = sc.attach_feedback(predictions(spark, sf), feedback(spark, sf))
    return rounded(sc.feedback_metrics(attached))


# ---- registry ---------------------------------------------------------------


def registry_entries(spark, sf, names, date, extra=0.0):
    """Registry rows for models evaluated on the scored events."""
    m = rounded(ev.ranking_areas(model_scores(spark, sf), ["model"])).where(F.col("model").isin(names))
    return m.select(
        F.concat("model", F.lit("_1.0")).alias("model_id"),
        F.col("model").alias("name"),
        F.lit("1.0").alias("version"),
        F.lit("rule").alias("model_type"),
        F.concat(F.lit("models/"), "model").alias("file_path"),
        F.create_map(
            F.lit("test_roc_auc"), F.col("roc_auc") + F.lit(extra), F.lit("test_pr_auc"), F.col("pr_auc")
        ).alias("performance_metrics"),
        F.lit(30).alias("feature_count"),
        F.lit(date).alias("training_date"),
        F.lit(0.0).alias("model_size_mb"),
        F.lit("active").alias("status"),
        F.lit(None).cast("string").alias("deployment_date"),
        F.create_map(F.lit("multiplier"), F.substring("model", 2, 10)).alias("hyperparameters"),
    )


def registry(spark, sf):
    first = registry_entries(spark, sf, [f"m{m}" for m in MULTIPLIERS], "2024-01-01")
    return rg.register(first, registry_entries(spark, sf, ["m7901"], "2024-02-01", extra=0.125))


_MS = "ms AS (" + " UNION ALL ".join(
    f"SELECT 'm{m}' AS model, Class AS label, {score_sql(m)} AS score FROM ev" for m in MULTIPLIERS
) + ")"
REG = (
    f"{EV}, {_MS}, g AS (SELECT model, score, SUM(label) AS p, COUNT(*) AS n FROM ms GROUP BY model, score), "
    "q AS (SELECT model, score, p, n, SUM(p) OVER w AS tp, SUM(n) OVER w AS k, SUM(p) OVER (PARTITION BY model) AS pt, SUM(n) OVER (PARTITION BY model) AS nt FROM g "
    "WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), "
    f"a AS (SELECT model, {R(AUC)} AS roc_auc, {R(AP)} AS pr_auc FROM q GROUP BY model), "
    "reg AS (SELECT model || '_1.0' AS model_id, model AS name, CASE WHEN model='m7901' THEN '2024-02-01' ELSE '2024-01-01' END AS training_date, "
    "CASE WHEN model='m7901' THEN roc_auc + 0.125 ELSE roc_auc END AS roc_auc, pr_auc FROM a)"
)


@query("R1_register", f"WITH {REG} SELECT model_id, name, '1.0' AS version, training_date, 'active' AS status, {R('roc_auc')} AS roc_auc FROM reg")
def _(spark, sf):
    roc = F.try_element_at("performance_metrics", F.lit("test_roc_auc"))
    return rounded(
        registry(spark, sf).select("model_id", "name", "version", "training_date", "status", roc.alias("roc_auc"))
    )


@query("R2_list_active", f"WITH {REG} SELECT model_id, training_date, 'active' AS status FROM reg WHERE model_id <> 'm7907_1.0'")
def _(spark, sf):
    reg = rg.deprecate(registry(spark, sf), "m7907_1.0")
    return rg.list_models(reg, "active").select("model_id", "training_date", "status")


@query("R3_ranking", f"WITH {REG} SELECT model_id, {R('roc_auc')} AS score FROM reg WHERE model_id <> 'm7907_1.0'")
def _(spark, sf):
    return rounded(rg.ranking(rg.deprecate(registry(spark, sf), "m7907_1.0")))


@query("R3_best_model", f"WITH {REG} SELECT model_id, {R('roc_auc')} AS score FROM reg ORDER BY roc_auc DESC, model_id LIMIT 1")
def _(spark, sf):
    return rounded(rg.best_model(registry(spark, sf)))


@query(
    "R4_export",
    f"WITH {REG} SELECT model_id, name, training_date, {R('roc_auc')} AS roc_auc, substr(name, 2) AS multiplier FROM reg",
)
def _(spark, sf):
    entry = F.from_json("entry", rg.SCHEMA)
    back = rg.export(registry(spark, sf)).select(entry.alias("e"))
    return rounded(
        back.select(
            "e.model_id", "e.name", "e.training_date",
            F.try_element_at("e.performance_metrics", F.lit("test_roc_auc")).alias("roc_auc"),
            F.try_element_at("e.hyperparameters", F.lit("multiplier")).alias("multiplier"),
        )
    )
