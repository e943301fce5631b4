"""Quality of scored rows: counts, thresholds, curves and areas.

``scored`` rows carry ``label`` (0/1) and ``score``. Everything starts from a
partial aggregate: confusion cells are conditional sums, and curves work on one
row per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareflow.operators.ordering import prefix_sums

THRESHOLDS = tuple(k / 20 for k in range(2, 20))
COST_FP, COST_FN = 1.0, 10.0


def binarize(df: DataFrame, threshold: float | None = None, out: str = "pred") -> DataFrame:
    t = 0.5 if threshold is None else threshold
    return df.withColumn(out, (F.col("score") >= F.lit(float(t))).cast("int"))


def _cells(weight: Column | None = None) -> list[Column]:
    w = F.lit(1) if weight is None else weight
    y, p = F.col("label"), F.col("pred")

    def cell(cond):
        return F.coalesce(F.sum(F.when(cond, w)), F.lit(0))

    return [
        cell((y == 0) & (p == 0)).alias("tn"),
        cell((y == 0) & (p == 1)).alias("fp"),
        cell((y == 1) & (p == 0)).alias("fn"),
        cell((y == 1) & (p == 1)).alias("tp"),
    ]


def confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp (one row, or one per group)."""
    return df.groupBy(*by).agg(*_cells()) if by else df.agg(*_cells())


def confusion_long(df: DataFrame) -> DataFrame:
    """Four rows with counts and the share of the true class."""
    cells = confusion(df)
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("label"),
                F.lit(p).alias("pred"),
                F.col(c).alias("n"),
                ratio(F.col(c), F.col(u) + F.col(v)).alias("share"),
            )
            for a, p, c, u, v in (
                (0, 0, "tn", "tn", "fp"),
                (0, 1, "fp", "tn", "fp"),
                (1, 0, "fn", "fn", "tp"),
                (1, 1, "tp", "fn", "tp"),
            )
        ]
    )
    return cells.select(F.inline(rows))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / F.when(b != 0, b))


def basic_metrics(cells: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cells.withColumns(
        {
            "n": tn + fp + fn + tp,
            "positives": fn + tp,
            "accuracy": ratio(tp + tn, tn + fp + fn + tp),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
            "specificity": ratio(tn, tn + fp),
        }
    )


def cost_metrics(cells: DataFrame, cost_fp: float = COST_FP, cost_fn: float = COST_FN) -> DataFrame:
    """Cost of the decisions and the saving against never flagging anything."""
    fp = F.col("fp") * F.lit(float(cost_fp))
    fn = F.col("fn") * F.lit(float(cost_fn))
    nothing = (F.col("fn") + F.col("tp")) * F.lit(float(cost_fn))
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cells.withColumns(
        {
            "total_cost": fp + fn,
            "avg_cost": ratio(fp + fn, n),
            "cost_reduction": ratio(nothing - fp - fn, nothing),
            "false_positive_cost": fp,
            "false_negative_cost": fn,
        }
    )


def score_groups(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: positives and rows."""
    return df.groupBy(*by, "score").agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("cnt")
    )


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float] = THRESHOLDS, by: Sequence[str] = ()
) -> DataFrame:
    """Basic and cost metrics at every threshold, from one aggregate of the rows.

    Rows are counted by how many thresholds they reach; the per-threshold cells are
    sums over that small table.
    """
    ts = sorted(thresholds)
    reached = F.lit(0)
    for t in ts:
        reached = reached + (F.col("score") >= F.lit(float(t))).cast("int")
    steps = df.groupBy(*by, reached.alias("reached")).agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("cnt")
    )
    grid = F.explode(
        F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(ts)])
    )
    flagged = F.col("reached") >= F.col("g.step")
    neg = F.col("cnt") - F.col("pos")

    def total(cond, value):
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))

    cells = (
        steps.select("*", grid.alias("g"))
        .groupBy(*by, F.col("g.threshold").alias("threshold"))
        .agg(
            total(~flagged, neg).alias("tn"),
            total(flagged, neg).alias("fp"),
            total(~flagged, F.col("pos")).alias("fn"),
            total(flagged, F.col("pos")).alias("tp"),
        )
    )
    return cost_metrics(basic_metrics(cells))


def best_threshold(sweep: DataFrame, metric: str = "f1_score") -> DataFrame:
    """Highest value (lowest for ``cost``); ties take the lowest threshold."""
    name = "total_cost" if metric == "cost" else metric
    order = F.col(name).asc() if metric == "cost" else F.col(name).desc()
    return sweep.orderBy(order, "threshold").limit(1).select(
        F.lit(metric).alias("metric"), "threshold", F.col(name).alias("value")
    )


def running_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from high to low: ``tp`` and ``flagged`` rows at ``score >= s``."""
    g = score_groups(df, by).withColumns({"tp": F.col("pos"), "flagged": F.col("cnt")})
    out = prefix_sums(g, "score", {"tp": "tp", "flagged": "flagged"}, by, descending=True)
    return out.withColumn("fp", F.col("flagged") - F.col("tp"))


def _class_totals(df: DataFrame, by: Sequence[str]) -> DataFrame:
    pos = F.sum(F.col("label").cast("bigint")).alias("P")
    neg = F.sum(1 - F.col("label").cast("bigint")).alias("N")
    return df.groupBy(*by).agg(pos, neg) if by else df.agg(pos, neg)


def _with_totals(run: DataFrame, df: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = _class_totals(df, by)
    if by:
        return run.join(totals, list(by))
    row = totals.first()
    return run.withColumns({"P": F.lit(row.P), "N": F.lit(row.N)})


def curve_points(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tpr, fpr, precision, recall and F1 at every distinct score."""
    run = _with_totals(running_counts(df, by), df, by)
    tp, fp, flagged = F.col("tp"), F.col("fp"), F.col("flagged")
    return run.withColumns(
        {
            "tpr": ratio(tp, F.col("P")),
            "fpr": ratio(fp, F.col("N")),
            "precision": ratio(tp, flagged),
            "f1": ratio(2 * tp, flagged + F.col("P")),
        }
    ).withColumn("recall", F.col("tpr"))


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties counting half."""
    run = _with_totals(running_counts(df, by), df, by)
    neg_same = F.col("cnt") - F.col("pos")
    neg_below = F.col("N") - F.col("fp")
    pairs = F.sum(F.col("pos").cast("double") * (neg_below + neg_same / 2.0))
    return run.groupBy(*by, "P", "N").agg(pairs.alias("_pairs")).select(
        *by, ratio(F.col("_pairs"), F.col("P").cast("double") * F.col("N")).alias("roc_auc")
    )


def average_precision(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum over scores of the recall step times the precision there."""
    run = _with_totals(running_counts(df, by), df, by)
    area = F.sum(F.col("pos").cast("double") * F.col("tp") / F.col("flagged"))
    return run.groupBy(*by, "P").agg(area.alias("_a")).select(
        *by, ratio(F.col("_a"), F.col("P")).alias("average_precision")
    )


def ranking_areas(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC and average precision from one pass over the running counts."""
    run = _with_totals(running_counts(df, by), df, by)
    neg_same = F.col("cnt") - F.col("pos")
    neg_below = F.col("N") - F.col("fp")
    sums = run.groupBy(*by, "P", "N").agg(
        F.sum(F.col("pos").cast("double") * (neg_below + neg_same / 2.0)).alias("_pairs"),
        F.sum(F.col("pos").cast("double") * F.col("tp") / F.col("flagged")).alias("_area"),
    )
    return sums.select(
        *by,
        ratio(F.col("_pairs"), F.col("P").cast("double") * F.col("N")).alias("roc_auc"),
        ratio(F.col("_area"), F.col("P")).alias("pr_auc"),
    )


def trapezoid_pr_auc(df: DataFrame) -> DataFrame:
    """Trapezoid area under precision(recall), anchored at recall 0, precision 1.

    The previous point of a score follows from its own row (tp - pos, flagged - cnt),
    so no lag over a global order is needed.
    """
    run = _with_totals(running_counts(df), df, ())
    tp0, k0 = F.col("tp") - F.col("pos"), F.col("flagged") - F.col("cnt")
    before = F.when(k0 == 0, F.lit(1.0)).otherwise(tp0.cast("double") / F.when(k0 != 0, k0))
    here = F.col("tp").cast("double") / F.col("flagged")
    step = F.col("pos").cast("double") / F.col("P")
    return run.agg(F.sum(step * (before + here) / 2.0).alias("pr_auc_trapezoid"))


def recall_at_fpr(df: DataFrame, limits: Sequence[float] = (0.01, 0.05)) -> DataFrame:
    pts = curve_points(df)
    return pts.agg(
        *[
            F.coalesce(F.max(F.when(F.col("fpr") <= x, F.col("tpr"))), F.lit(0.0)).alias(
                f"recall_at_fpr_{round(x * 100)}pct"
            )
            for x in limits
        ]
    )


def classification_report(df: DataFrame) -> DataFrame:
    """Per class precision, recall, F1, support; then macro and weighted means."""
    c = confusion(df)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))

    def entry(name, hit, flagged, actual):
        return F.struct(
            F.lit(name).alias("class"),
            ratio(hit, flagged).alias("precision"),
            ratio(hit, actual).alias("recall"),
            ratio(2 * hit, flagged + actual).alias("f1_score"),
            actual.alias("support"),
        )

    per = c.select(
        "*",
        F.array(entry("0", tn, tn + fn, tn + fp), entry("1", tp, tp + fp, tp + fn)).alias("e"),
        (tn + fp + fn + tp).alias("total"),
    )
    a, b = F.element_at("e", 1), F.element_at("e", 2)

    def mean(name, wa, wb):
        fields = [
            ((a[m] * wa + b[m] * wb)).alias(m) for m in ("precision", "recall", "f1_score")
        ]
        return F.struct(F.lit(name).alias("class"), *fields, F.col("total").alias("support"))

    half = F.lit(0.5)
    acc = ratio(tp + tn, F.col("total"))
    rows = F.concat(
        F.col("e"),
        F.array(
            mean("macro avg", half, half),
            mean("weighted avg", ratio(a["support"], F.col("total")), ratio(b["support"], F.col("total"))),
            F.struct(
                F.lit("accuracy").alias("class"),
                acc.alias("precision"),
                acc.alias("recall"),
                acc.alias("f1_score"),
                F.col("total").alias("support"),
            ),
        ),
    )
    return per.select(F.inline(rows))


def all_metrics(df: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Basic metrics at a threshold with ROC AUC and average precision, per group if given."""
    basic = basic_metrics(confusion(binarize(df, threshold), by))
    areas = ranking_areas(df, by)
    if by:
        return basic.join(areas, list(by))
    return basic.withColumn("_k", F.lit(1)).join(
        areas.withColumn("_k", F.lit(1)), "_k"
    ).drop("_k")


METRIC_NAMES = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc")


def metrics_long(metrics: DataFrame, names: Sequence[str] = METRIC_NAMES, by: Sequence[str] = ()) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
    )
    return metrics.select(*by, F.inline(rows))


def best_per_metric(long: DataFrame, model: str = "model") -> DataFrame:
    """Model with the highest value of every metric; ties take the first name."""
    w = Window.partitionBy("metric").orderBy(F.col("value").desc(), model)
    return (
        long.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    )


def business_impact(
    df: DataFrame, threshold: float = 0.5, cost_fp: float = COST_FP
) -> DataFrame:
    """Amounts by confusion cell and the net benefit of acting on the flags."""
    b = binarize(df, threshold)
    y, p, amt = F.col("label"), F.col("pred"), F.col("Amount")

    def money(cond):
        return F.coalesce(F.sum(F.when(cond, amt)), F.lit(0.0))

    sums = b.agg(
        money(y == 1).alias("positive_amount"),
        money((y == 1) & (p == 1)).alias("caught_amount"),
        money((y == 1) & (p == 0)).alias("missed_amount"),
        F.count_if((y == 0) & (p == 1)).alias("false_alarms"),
    )
    return sums.withColumn(
        "net_benefit",
        F.col("caught_amount")
        - F.lit(float(cost_fp)) * F.col("false_alarms")
        - F.col("missed_amount"),
    )


def full_evaluation(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: basic and cost metrics, areas, recall at 1 % FPR and best thresholds."""
    pts = _with_totals(running_counts(df), df, ())
    neg_same = F.col("cnt") - F.col("pos")
    neg_below = F.col("N") - F.col("fp")
    fpr, tpr = ratio(F.col("fp"), F.col("N")), ratio(F.col("tp"), F.col("P"))
    pos = F.col("pos").cast("double")
    curve = pts.agg(
        (F.sum(pos * (neg_below + neg_same / 2.0)) / F.max(F.col("P").cast("double") * F.col("N"))).alias("roc_auc"),
        (F.sum(pos * F.col("tp") / F.col("flagged")) / F.max("P")).alias("pr_auc"),
        F.coalesce(F.max(F.when(fpr <= 0.01, tpr)), F.lit(0.0)).alias("recall_at_fpr_1pct"),
    ).first()
    sweep = threshold_sweep(df)
    best = sweep.agg(
        F.max_by("threshold", F.struct("f1_score", -F.col("threshold"))).alias("f1"),
        F.min_by("threshold", F.struct("total_cost", "threshold")).alias("cost"),
    ).first()
    cells = confusion(binarize(df, threshold))
    out = cost_metrics(basic_metrics(cells)).drop("tn", "fp", "fn", "tp", "n", "positives")
    return out.withColumns(
        {
            **{k: F.lit(v) for k, v in curve.asDict().items()},
            "best_f1_threshold": F.lit(best.f1),
            "best_cost_threshold": F.lit(best.cost),
        }
    )
