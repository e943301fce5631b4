"""Distributed training and scoring of classifiers."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.keys import KEY_SPACE
from rareflow.operators import evaluation as ev
from rareflow.operators.perceptron import Perceptron
from rareflow.operators.sampling import (
    balanced_weights,
    class_ranks,
    class_sizes,
    oversample,
    stratified_folds,
)
from rareflow.session import shared_dir, stored


def assembler(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="error")


def assemble(df: DataFrame, cols: Sequence[str], target: str = "Class") -> DataFrame:
    """Feature vector and label; nulls raise."""
    return assembler(cols).transform(df.withColumn("label", F.col(target)))


def labelled(df: DataFrame, target: str = "Class") -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))


# ---- estimators -------------------------------------------------------------


def logistic(c: float = 1.0, l1: bool = False, n: int = 1, **kw) -> LogisticRegression:
    """``c`` is the inverse penalty on the summed loss; the estimator penalizes the mean."""
    return LogisticRegression(
        regParam=1.0 / (c * max(1, n)), elasticNetParam=1.0 if l1 else 0.0, maxIter=100,
        weightCol="weight", **kw,
    )


def forest(trees: int = 100, depth: int = 10, leaf: int = 5, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="sqrt",
        weightCol="weight", seed=seed,
    )


def boosted(
    rounds: int = 100, depth: int = 6, rate: float = 0.1, rows: float = 0.8, cols: str = "0.8",
    seed: int = 42,
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
        featureSubsetStrategy=cols, weightCol="weight", seed=seed,
    )


def perceptron(inputs: int, hidden: Sequence[int] = (100, 50), rounds: int = 100, seed: int = 42):
    """Feed-forward net on standardized inputs. It takes no weights: rebalance its rows."""
    return [
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        Perceptron(
            featuresCol="scaled", layers=[inputs, *hidden, 2], maxIter=rounds, seed=seed
        ),
    ]


# Model configurations.
def configurations(n: int) -> dict[str, Callable[[], Estimator]]:
    return {
        "logistic": lambda: logistic(1.0, n=n),
        "forest": lambda: forest(100, 10, 5),
        "boosted_fast": lambda: boosted(100, 6, 0.1, 0.8, "0.8"),
        "boosted_small": lambda: boosted(100, 3, 0.1, 0.8, "sqrt"),
    }


def fit(
    train: DataFrame, cols: Sequence[str], estimator: Estimator | Sequence, target: str = "Class",
    weights: str | None = "balanced",
) -> PipelineModel:
    """``weights``: "balanced", a number for positives (as text or float), or None."""
    rows = labelled(train, target)
    if weights == "balanced":
        rows = balanced_weights(rows, target)
    elif weights is not None:
        rows = rows.withColumn(
            "weight", F.when(F.col(target) == 1, F.lit(float(weights))).otherwise(1.0)
        )
    elif "weight" not in rows.columns:
        rows = rows.withColumn("weight", F.lit(1.0))
    stages = list(estimator) if isinstance(estimator, (list, tuple)) else [estimator]
    return Pipeline(stages=[assembler(cols), *stages]).fit(rows)


def probability(df: DataFrame, model: Transformer, out: str = "score") -> DataFrame:
    """Adds the positive probability and drops every working column of the model."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def score(
    df: DataFrame, model: Transformer, target: str = "Class", key: str = "txn_id",
    threshold: float = 0.5, keep: Sequence[str] = (),
) -> DataFrame:
    out = probability(df, model).select(
        key, F.col(target).cast("int").alias("label"), "score", *keep
    )
    return ev.binarize(out, threshold)


# ---- AdaBoost ---------------------------------------------------------------


@dataclass
class AdaBoost:
    stumps: list[PipelineModel]
    alphas: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Signed weighted vote of the stumps, squashed to (0, 1)."""
        keep = df.columns
        vote = F.lit(0.0)
        out = df
        for i, (m, a) in enumerate(zip(self.stumps, self.alphas)):
            out = m.transform(out).withColumn(f"_p{i}", F.col("prediction")).select(
                *keep, *[f"_p{j}" for j in range(i + 1)]
            )
            vote = vote + F.lit(a) * (F.col(f"_p{i}") * 2.0 - 1.0)
        total = sum(abs(a) for a in self.alphas) or 1.0
        return out.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-vote / F.lit(total) * 4.0))).select(
            *keep, "score"
        )


def fit_adaboost(
    train: DataFrame, cols: Sequence[str], rounds: int = 100, target: str = "Class", every: int = 10
) -> AdaBoost:
    """Boosted one-level trees. Weights live in a column that is checkpointed regularly."""
    shared_dir(train.sparkSession)
    rows = balanced_weights(labelled(train.select(*cols, target), target), target)
    rows = assembler(cols).transform(rows).select("features", "label", "weight").checkpoint()
    stump = DecisionTreeClassifier(maxDepth=1, weightCol="weight")
    models, alphas = [], []
    for i in range(rounds):
        tree = Pipeline(stages=[stump]).fit(rows)
        hit = tree.transform(rows).withColumn("_wrong", (F.col("prediction") != F.col("label")).cast("double"))
        err, total = hit.agg(F.sum(F.col("weight") * F.col("_wrong")), F.sum("weight")).first()
        err = min(max(err / total, 1e-10), 1.0)
        if err >= 0.5:
            break
        alpha = math.log((1.0 - err) / err)
        models.append(tree)
        alphas.append(alpha)
        scale = total * (1.0 - err + err * math.exp(alpha))
        rows = hit.select(
            "features", "label",
            (F.col("weight") * F.exp(F.lit(alpha) * F.col("_wrong")) / F.lit(scale / total)).alias("weight"),
        )
        if (i + 1) % every == 0:
            rows = rows.checkpoint()
    full = [PipelineModel([assembler(cols), *m.stages]) for m in models]
    return AdaBoost(full, alphas)


# ---- ensembles --------------------------------------------------------------

#: Blends that one pass ranks: each row is repeated so many times.
CANDIDATES = 22


def member_scores(df: DataFrame, models: Mapping[str, Transformer]) -> DataFrame:
    """One score column per model, added in one pass over the rows: no join."""
    for name, m in models.items():
        df = probability(df, m, f"score_{name}")
    return df


def soft_vote(df: DataFrame, names: Sequence[str], weights: Sequence[float] | None = None) -> DataFrame:
    w = list(weights or [1.0] * len(names))
    total = sum((F.col(f"score_{n}") * F.lit(float(x)) for n, x in zip(names, w)), F.lit(0.0))
    return df.withColumn("score", total / F.lit(float(sum(w))))


def simplex(parts: int, steps: int) -> list[tuple[float, ...]]:
    """All weight vectors with entries k/steps that sum to one."""
    if parts == 1:
        return [(1.0,)]
    out = []

    def fill(prefix, left):
        if len(prefix) == parts - 1:
            out.append(tuple(x / steps for x in (*prefix, left)))
            return
        for k in range(left + 1):
            fill((*prefix, k), left - k)

    fill((), steps)
    return out


def search_weights(
    df: DataFrame, names: Sequence[str], steps: int = 10, refine: bool = True
) -> tuple[list[float], float]:
    """Weights with the best average precision on validation rows, by the exact ranking of every blend.

    ``CANDIDATES`` blends are ranked in one pass, each in ranges of its own; rows with
    equal scores fold to one count first. Ties go to the candidate that stands first.
    """
    rows = stored(df.select("label", *[f"score_{n}" for n in names]), "member-scores")

    def best(candidates):
        found = []
        for at in range(0, len(candidates), CANDIDATES):
            blends = [
                F.struct(
                    F.lit(i).alias("candidate"),
                    sum((F.col(f"score_{n}") * F.lit(x) for n, x in zip(names, candidates[i])), F.lit(0.0)).alias("score"),
                )
                for i in range(at, min(at + CANDIDATES, len(candidates)))
            ]
            long = rows.select("label", F.inline(F.array(*blends)))
            found += [(r["average_precision"], -r["candidate"]) for r in ev.average_precision(long, ["candidate"]).collect()]
        ap, i = max(found)
        return candidates[-i], ap

    w, ap = best(simplex(len(names), steps))
    if refine:
        half = 0.5 / steps
        near = [w]
        for i in range(len(names)):
            for j in range(len(names)):
                if i != j and w[j] >= half:
                    v = list(w)
                    v[i] += half
                    v[j] -= half
                    near.append(tuple(v))
        w, ap = best(near)
    return list(w), ap


@dataclass
class Stacked:
    base: dict[str, Transformer]
    meta: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.meta.transform(member_scores(df, self.base))


def fit_stacking(
    train: DataFrame, cols: Sequence[str], base: Mapping[str, Callable[[], Estimator]], folds: int = 5,
    target: str = "Class", key: str = "txn_id",
) -> Stacked:
    """Out-of-fold scores train the meta model; base models are refitted on all rows."""
    shared_dir(train.sparkSession)
    rows = stratified_folds(train, folds, target, key=key).checkpoint()
    parts = None
    for k in range(folds):
        inside, held = rows.where(F.col("fold") != k), rows.where(F.col("fold") == k)
        models = {n: fit(inside, cols, make(), target) for n, make in base.items()}
        part = member_scores(held, models).select(key, target, *[f"score_{n}" for n in base])
        parts = part if parts is None else parts.unionByName(part)
    meta_rows = parts.checkpoint()
    meta = fit(meta_rows, [f"score_{n}" for n in base], logistic(1.0, n=meta_rows.count()), target)
    full = {n: fit(rows, cols, make(), target) for n, make in base.items()}
    stages = [assembler([f"score_{n}" for n in base]), *meta.stages[1:]]
    return Stacked(full, PipelineModel(stages))


def train_several(
    train: DataFrame, validation: DataFrame, test: DataFrame, cols: Sequence[str],
    makers: Mapping[str, Callable[[], Estimator]], target: str = "Class",
) -> tuple[DataFrame, str, dict[str, PipelineModel]]:
    """Fit each model, skip those that fail, pick the best by validation average precision."""
    spark = train.sparkSession
    models, rows = {}, []
    for name, make in makers.items():
        try:
            models[name] = fit(train, cols, make(), target)
        except Exception as e:  # noqa: BLE001 - a failing model must not stop the others
            rows.append((name, "failed", None, None, None, None, None, str(e)[:200]))
    for name, m in models.items():
        for part, df in (("validation", validation), ("test", test)):
            r = ev.all_metrics(score(df, m, target)).first()
            rows.append((name, part, r.precision, r.recall, r.f1_score, r.roc_auc, r.pr_auc, None))
    schema = (
        "model string, split string, precision double, recall double, f1_score double, "
        "roc_auc double, pr_auc double, error string"
    )
    table = spark.createDataFrame(rows, schema)
    valid = [(r[6], r[0]) for r in rows if r[1] == "validation"]
    best = max(valid)[1] if valid else ""
    return table.withColumn("is_best", F.col("model") == F.lit(best)), best, models


# ---- importance -------------------------------------------------------------


def importances(model: PipelineModel, cols: Sequence[str]) -> list[tuple[str, float]]:
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = abs(last.coefficients.toArray())
    return [(c, float(v)) for c, v in zip(cols, values)]


def importance_frame(spark, model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(importances(model, cols), "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def weighted_importance(frames: Mapping[str, DataFrame], weights: Mapping[str, float]) -> DataFrame:
    """Sum over models of weight times importance."""
    parts = None
    for name, df in frames.items():
        part = df.select("feature", (F.col("importance") * F.lit(float(weights[name]))).alias("importance"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("feature").agg(F.sum("importance").alias("importance"))


def linear_contributions(df: DataFrame, model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    """Mean absolute contribution coef * (x - mean) of every feature."""
    coef = model.stages[-1].coefficients.toArray()
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    wide = df.agg(
        *[F.avg(F.abs(F.lit(float(b)) * (F.col(c) - F.lit(means[c])))).alias(c) for c, b in zip(cols, coef)]
    )
    return wide.unpivot([], list(cols), "feature", "contribution")


#: Ranks whose rows are exchanged by one task.
RANKS = 8192


def _exchanged(
    df: DataFrame, which: Sequence[str], keep: Sequence[str], key: str, seed: int, size: int = RANKS
) -> DataFrame:
    """``keep`` and for each column of ``which`` the value ``_new_i`` of the row a fixed offset before in permutation order.

    Ranks are cut into blocks. The offsets differ by a few ranks a column, so a block
    needs the rows of about as many other ranks, sent to it once for all columns. A row
    without a key takes part, too: the hash of its values stands for it.
    """
    named = F.coalesce(F.col(key).cast("bigint"), F.pmod(F.xxhash64(*keep), F.lit(KEY_SPACE)))
    shared_dir(df.sparkSession)
    ranked = class_ranks(df.select(*keep, named.alias("_key")), "_key", seed).drop("_key").checkpoint()
    n = ranked.count()
    shifts = [(n // 2 + i * 7 + 1) % max(1, n) for i in range(len(which))]

    def block(rank):
        return F.floor(rank / F.lit(size))

    needed = F.transform(F.array(*[F.lit(s) for s in shifts]), lambda s: block((F.col("rank") + s) % F.lit(n)))
    sent = ranked.withColumn("_block", F.explode(F.array_distinct(F.concat(F.array(block(F.col("rank"))), needed))))

    def exchange(rows: pa.Table) -> pa.Table:
        rank = rows["rank"].to_numpy()
        mine = np.flatnonzero(rank // size == rows["_block"][0].as_py())
        order = np.argsort(rank)
        found = rows.select(list(keep)).take(pa.array(mine))
        for i, (c, shift) in enumerate(zip(which, shifts)):
            donor = order[np.searchsorted(rank, (rank[mine] - shift) % n, sorter=order)]
            found = found.append_column(f"_new_{i}", rows[c].take(pa.array(donor)))
        return found

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    kinds += [f"_new_{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(which)]
    return sent.groupBy("_block").applyInArrow(exchange, ", ".join(kinds))


def permutation_importance(
    df: DataFrame, model: PipelineModel, cols: Sequence[str], which: Sequence[str] | None = None,
    target: str = "Class", key: str = "txn_id", seed: int = 42,
) -> DataFrame:
    """Drop of average precision when one column is exchanged between rows, for every column or those of ``which``.

    Each row takes the value of the row a fixed offset before it in permutation order. All
    exchanges come from one shuffle, and the rankings of all columns from one pass.
    """
    which = list(cols if which is None else which)
    mixed = stored(_exchanged(df, which, [target, *cols], key, seed), "exchanged")
    parts = None
    for i, c in enumerate([None, *which]):
        rows = mixed if c is None else mixed.withColumn(c, F.col(f"_new_{i - 1}"))
        scored = probability(rows.select(target, *cols), model).select(
            F.lit(i).alias("candidate"), F.col(target).cast("int").alias("label"), "score"
        )
        parts = scored if parts is None else parts.unionByName(scored)
    areas = ev.average_precision(stored(parts, "exchanged-scores"), ["candidate"]).collect()  # one row a column
    ap = {r["candidate"]: r["average_precision"] for r in areas}
    return df.sparkSession.createDataFrame(
        [(c, float(ap[0] - ap[i])) for i, c in enumerate(which, 1)], "feature string, ap_drop double"
    )


def rebalanced_for_net(train: DataFrame, target: str = "Class", key: str = "txn_id", seed: int = 42) -> DataFrame:
    """Weights are not available to the net, so its positives are repeated instead.

    The rows are written once, as many of them for every core: draws come from a join on
    few positives, which leaves half of all rows to one task in each step of the fit.
    """
    if not class_sizes(train, target).get(1):
        return train
    rows = oversample(train, target, key, seed)
    return stored(rows.repartition(train.sparkSession.sparkContext.defaultParallelism, key, "copy"), "net-rows")

