"""Unsupervised anomaly scores: isolation forest and reconstruction error."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.functions.keys import perm_key
from rareflow.functions.shape import stats_by_feature
from rareflow.operators import evaluation as ev
from rareflow.operators.pca import PcaParams, fit_pca, with_reconstruction_error
from rareflow.operators.quantiles import exact_quantiles
from rareflow.operators.sampling import class_ranks

CONTAMINATION = 0.002


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def grow_tree(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Random axis cuts as a flat list: (feature, cut, left, right) or (-1, path, 0, 0)."""
    nodes: list[tuple] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(())
        lo, hi = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        usable = np.flatnonzero(hi > lo) if len(rows) > 1 else []
        if depth >= limit or len(usable) == 0:
            nodes[at] = (-1, depth + average_path(len(rows)), 0, 0)
            return at
        f = int(rng.choice(usable))
        cut = float(rng.uniform(lo[f], hi[f]))
        left = rows[:, f] < cut
        a, b = grow(rows[left], depth + 1), grow(rows[~left], depth + 1)
        nodes[at] = (f, cut, a, b)
        return at

    grow(points, 0)
    return nodes


def path_lengths(tree: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Depth reached by every row of a batch, walking all rows level by level."""
    feature = tree[:, 0].astype(int)
    at = np.zeros(len(x), dtype=int)
    while True:
        f = feature[at]
        open_rows = np.flatnonzero(f >= 0)
        if len(open_rows) == 0:
            return tree[at, 1]
        node = at[open_rows]
        left = x[open_rows, f[open_rows]] < tree[node, 1]
        at[open_rows] = np.where(left, tree[node, 2], tree[node, 3]).astype(int)


@dataclass(frozen=True)
class IsolationForest:
    columns: list[str]
    trees: list[list[tuple]]
    sample_size: int
    contamination: float


def fit_isolation_forest(
    df: DataFrame, cols: Sequence[str], trees: int = 100, sample: int = 256,
    contamination: float = CONTAMINATION, key: str = "txn_id", seed: int = 42,
) -> IsolationForest:
    """Each tree sees ``sample`` rows, so all trees together need trees * sample rows.

    One permutation order is cut into consecutive samples. Trees grow in parallel
    tasks, one sample per task.
    """
    total = df.count()
    size = min(sample, total)
    want = min(total, trees * size)
    picked = df.select(key, *cols).orderBy(perm_key(key, seed), key).limit(want)
    numbered = class_ranks(picked, key, seed)
    copies = -(-trees * size // want)
    numbered = numbered.select(
        *cols,
        F.explode(F.array(*[(F.col("rank") + F.lit(i * want)) for i in range(copies)])).alias("draw"),
    ).where(F.col("draw") < trees * size)
    rows = numbered.withColumn("tree", F.floor(F.col("draw") / size).cast("int"))
    limit = max(1, math.ceil(math.log2(max(2, size))))
    cols = list(cols)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        no = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values("draw")
        nodes = grow_tree(pdf[cols].to_numpy(float), np.random.default_rng(seed + no), limit)
        return pd.DataFrame({"tree": [no], "nodes": [[list(map(float, n)) for n in nodes]]})

    grown = rows.groupBy("tree").applyInPandas(grow, "tree int, nodes array<array<double>>")
    trees_out = [[tuple(n) for n in r.nodes] for r in grown.orderBy("tree").collect()]
    return IsolationForest(cols, trees_out, size, contamination)


def score_isolation_forest(df: DataFrame, forest: IsolationForest) -> DataFrame:
    """Adds ``anomaly_score`` in (0, 1), and flags the highest ``contamination`` share."""
    shared = df.sparkSession.sparkContext.broadcast(
        [np.array(t) for t in forest.trees]  # trees * sample nodes at most
    )
    norm = average_path(forest.sample_size)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for pdf in batches:
            x = pdf.to_numpy(float)
            depth = np.zeros(len(x))
            for t in shared.value:
                depth += path_lengths(t, x)
            yield pd.Series(np.exp2(-depth / len(shared.value) / norm))

    out = df.withColumn("anomaly_score", score(F.struct(*forest.columns)))
    cut = exact_quantiles(out, {"s": F.col("anomaly_score")}, [1.0 - forest.contamination])["s"][0]
    return out.withColumn("is_anomaly", (F.col("anomaly_score") > F.lit(cut)).cast("int"))


def anomaly_quality(scored: DataFrame, target: str = "Class") -> DataFrame:
    flagged = scored.select(F.col(target).alias("label"), F.col("is_anomaly").alias("pred"))
    return ev.basic_metrics(ev.confusion(flagged)).select(
        "tp", "fp", "fn", "tn", "precision", "recall", "f1_score"
    )


def relevance(scored: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Absolute correlation of every feature with the anomaly score."""
    return stats_by_feature(
        scored, cols, {"relevance": lambda c: F.abs(F.corr(c, F.col("anomaly_score")))}
    )


@dataclass(frozen=True)
class Reconstruction:
    components: PcaParams
    threshold: float


def fit_reconstruction(
    df: DataFrame, cols: Sequence[str], k: int = 8, contamination: float = CONTAMINATION, target: str = "Class"
) -> Reconstruction:
    """Learn the normal rows only; the threshold is their (1 - contamination) quantile."""
    normal = df.where(F.col(target) == 0)
    p = fit_pca(normal, cols, k, standardize=True)
    errors = with_reconstruction_error(normal, p, "_e")
    cut = exact_quantiles(errors, {"e": F.col("_e")}, [1.0 - contamination])["e"][0]
    return Reconstruction(p, cut)


def score_reconstruction(df: DataFrame, model: Reconstruction) -> DataFrame:
    error = F.col("reconstruction_error")
    cut = F.lit(model.threshold)
    return with_reconstruction_error(df, model.components, "reconstruction_error").withColumns(
        {
            "anomaly_score": F.least(F.lit(1.0), F.greatest(F.lit(0.0), error / (cut * 2.0))),
            "is_anomaly": (error > cut).cast("int"),
        }
    )
