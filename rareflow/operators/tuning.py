"""Hyper-parameter search and model-driven feature selection."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.operators import evaluation as ev
from rareflow.operators import models as md
from rareflow.operators import selection as sel
from rareflow.operators.sampling import balanced_weights, bootstrap_weights, stratified_folds


class RankingEvaluator(Evaluator):
    """Average precision or ROC AUC with exact handling of ties."""

    def __init__(self, metric: str = "average_precision"):
        super().__init__()
        self.metric = metric

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(
            F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("score")
        )
        fn = ev.average_precision if self.metric == "average_precision" else ev.roc_auc
        return float(fn(scored).first()[0])

    def isLargerBetter(self) -> bool:
        return True


def _rows(train: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    rows = md.assembler(cols).transform(balanced_weights(md.labelled(train, target), target))
    return rows.drop(*cols)


def param_grid(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def _table(spark, maps, metrics) -> DataFrame:
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(a))
        for i, (m, a) in enumerate(zip(maps, metrics))
    ]
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return spark.createDataFrame(rows, "trial int, params string, metric double").withColumn(
        "is_best", F.col("trial") == best
    )


def grid_search(
    train: DataFrame, cols: Sequence[str], estimator: Estimator, grid: Mapping[str, Sequence],
    folds: int = 3, metric: str = "average_precision", target: str = "Class", key: str = "txn_id",
    parallelism: int = 4,
):
    """Stratified cross-validated grid; returns the model and one row per grid point."""
    rows = stratified_folds(_rows(train, cols, target), folds, target, key=key).persist()
    maps = param_grid(estimator, grid)
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=RankingEvaluator(metric),
        numFolds=folds, foldCol="fold", parallelism=parallelism,
    )
    fitted = cv.fit(rows)
    rows.unpersist()
    return fitted.bestModel, _table(train.sparkSession, maps, fitted.avgMetrics)


# Search ranges of the boosted trees.
BOOSTED_RANGES = {
    "maxIter": (100, 500),
    "maxDepth": (3, 10),
    "stepSize": (0.01, 0.3),
    "subsamplingRate": (0.6, 1.0),
}


def random_trials(estimator: Estimator, ranges: Mapping[str, tuple], trials: int, seed: int = 42) -> list[dict]:
    """Seeded draws: whole numbers for whole-number ranges, uniform otherwise."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        draw = {}
        for name, (lo, hi) in ranges.items():
            whole = isinstance(lo, int) and isinstance(hi, int)
            draw[estimator.getParam(name)] = rng.randint(lo, hi) if whole else rng.uniform(lo, hi)
        out.append(draw)
    return out


def random_search(
    train: DataFrame, cols: Sequence[str], estimator: Estimator, ranges: Mapping[str, tuple] = BOOSTED_RANGES,
    trials: int = 50, seed: int = 42, metric: str = "average_precision", target: str = "Class",
    parallelism: int = 4,
):
    rows = _rows(train, cols, target).persist()
    maps = random_trials(estimator, ranges, trials, seed)
    tvs = TrainValidationSplit(
        estimator=estimator, estimatorParamMaps=maps, evaluator=RankingEvaluator(metric),
        trainRatio=0.8, seed=seed, parallelism=parallelism,
    )
    fitted = tvs.fit(rows)
    rows.unpersist()
    return fitted.bestModel, _table(train.sparkSession, maps, fitted.validationMetrics)


# ---- model-driven selection -------------------------------------------------


def recursive_elimination(
    df: DataFrame, cols: Sequence[str], make: Callable[[], Estimator], least: int = 30, step: int = 1,
    folds: int = 3, target: str = "Class", key: str = "txn_id",
) -> tuple[list[str], DataFrame]:
    """Drop the weakest feature(s) round by round; keep the set with the best mean ROC AUC."""
    rows = stratified_folds(df.select(key, target, *cols), folds, target, key=key).persist()
    current, history = list(cols), []
    while True:
        aucs = []
        totals = dict.fromkeys(current, 0.0)
        for k in range(folds):
            m = md.fit(rows.where(F.col("fold") != k), current, make(), target)
            held = md.score(rows.where(F.col("fold") == k), m, target, key)
            aucs.append(ev.roc_auc(held).first()[0])
            for c, v in md.importances(m, current):
                totals[c] += v
        history.append((len(current), sum(aucs) / folds, list(current)))
        if len(current) <= least:
            break
        drop = min(step, len(current) - least)
        weakest = sorted(current, key=lambda c: (totals[c], c))[:drop]
        current = [c for c in current if c not in weakest]
    rows.unpersist()
    best = max(history, key=lambda h: (h[1], -h[0]))
    table = df.sparkSession.createDataFrame(
        [(n, float(a), n == best[0]) for n, a, _ in history], "n_features int, mean_auc double, is_best boolean"
    )
    return best[2], table


def select_from_model(
    df: DataFrame, cols: Sequence[str], estimator: Estimator, threshold: str | float = "median",
    target: str = "Class",
) -> list[tuple[str, float]]:
    """Features whose importance reaches the median, the mean or a number."""
    scores = md.importances(md.fit(df, cols, estimator, target), cols)
    values = sorted(v for _, v in scores)
    if threshold == "median":
        n = len(values)
        cut = (values[(n - 1) // 2] + values[n // 2]) / 2
    elif threshold == "mean":
        cut = sum(values) / len(values)
    else:
        cut = float(threshold)
    return [(c, v) for c, v in scores if v >= cut]


def stability(
    df: DataFrame, cols: Sequence[str], make: Callable[[int], Estimator], rounds: int = 20,
    keep: float = 0.6, target: str = "Class", seed: int = 42,
) -> DataFrame:
    """How often a feature is in the better half over bootstrap fits."""
    rows = balanced_weights(df.select("txn_id", target, *cols), target, "class_weight").persist()
    picked = []
    for b in range(rounds):
        drawn = bootstrap_weights(rows, seed + b, "draws").where(F.col("draws") > 0)
        weighted = drawn.withColumn("weight", F.col("draws") * F.col("class_weight"))
        scores = md.importances(md.fit(weighted, cols, make(seed + b), target, weights=None), cols)
        best = sorted(scores, key=lambda x: (-x[1], x[0]))[: len(cols) // 2]
        picked += [(b, c) for c, _ in best]
    rows.unpersist()
    spark = df.sparkSession
    freq = spark.createDataFrame(picked, "round int, feature string").groupBy("feature").agg(
        (F.count(F.lit(1)) / float(rounds)).alias("frequency")
    )
    every = spark.createDataFrame([(c,) for c in cols], "feature string")
    out = every.join(freq, "feature", "left").fillna(0.0, ["frequency"])
    return out.withColumn("kept", F.col("frequency") >= F.lit(keep))


def select_features(
    df: DataFrame, cols: Sequence[str], method: str = "univariate", k: int = 10, target: str = "Class",
    variance: float = 0.01, correlation: float = 0.95,
) -> dict[str, list[str]]:
    """Variance filter, correlation filter, then one method; every stage's names."""
    kept = {r.feature for r in sel.low_variance_filter(df, cols, variance).where("kept").collect()}
    varied = [c for c in cols if c in kept]
    loose = sel.correlation_filter(df, varied, correlation)
    if method == "univariate":
        final = [r.feature for r in sel.select_k_best(sel.anova_f(df, loose, target), "f_score", k).collect()]
    elif method == "mutual_information":
        scores = sel.mutual_information(df, loose, target)
        final = [r.feature for r in sel.select_k_best(scores, "mutual_information", k).collect()]
    elif method == "model":
        final = [c for c, _ in select_from_model(df, loose, md.forest(20, 6), "median", target)]
    elif method == "vote":
        a = [r.feature for r in sel.select_k_best(sel.anova_f(df, loose, target), "f_score", k).collect()]
        b = [
            r.feature
            for r in sel.select_k_best(sel.mutual_information(df, loose, target), "mutual_information", k).collect()
        ]
        c = [x for x, _ in select_from_model(df, loose, md.forest(20, 6), "median", target)]
        votes = sel.vote({"anova": a, "mutual_information": b, "model": c}, df.sparkSession)
        final = [r.feature for r in votes.orderBy(F.col("votes").desc(), "feature").collect()]
    else:
        raise ValueError(f"unknown method {method!r}")
    return {"variance": varied, "correlation": loose, "selected": final}
