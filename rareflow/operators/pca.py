"""Principal components on centred columns, with a fixed sign."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class PcaParams:
    columns: list[str]
    mean: list[float]
    scale: list[float]
    loadings: np.ndarray  # columns x components
    explained: list[float]


def fit_pca(df: DataFrame, cols: Sequence[str], k: int, standardize: bool = False) -> PcaParams:
    cols = list(cols)
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()
    mean = [row[f"m_{c}"] for c in cols]
    scale = [(row[f"s_{c}"] or 1.0) if standardize else 1.0 for c in cols]
    scaled = F.array(*[(F.col(c) - m) / s for c, m, s in zip(cols, mean, scale)])
    vec = df.select(array_to_vector(scaled).alias("_v"))
    model = PCA(k=min(k, len(cols)), inputCol="_v", outputCol="_p").fit(vec)
    loadings = model.pc.toArray()
    # the largest loading of every component is positive
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), range(loadings.shape[1])])
    return PcaParams(cols, mean, scale, loadings * signs, list(model.explainedVariance.toArray()))


def component_columns(p: PcaParams) -> list[Column]:
    return [
        F.expr(
            " + ".join(
                f"({c} - {m!r}D) / {s!r}D * {float(p.loadings[i, j])!r}D"
                for i, (c, m, s) in enumerate(zip(p.columns, p.mean, p.scale))
            )
        )
        for j in range(p.loadings.shape[1])
    ]


def apply_pca(df: DataFrame, p: PcaParams, prefix: str = "PCA_") -> DataFrame:
    return df.withColumns({f"{prefix}{j}": c for j, c in enumerate(component_columns(p))})


def project_components(
    df: DataFrame, cols: Sequence[str], k: int, ids: Sequence[str], standardize: bool = False
) -> DataFrame:
    p = fit_pca(df, cols, k, standardize)
    out = apply_pca(df, p).select(*ids, *[f"PCA_{j}" for j in range(k)])
    return out.withColumns({f"explained_{j}": F.lit(float(p.explained[j])) for j in range(k)})


def with_reconstruction_error(df: DataFrame, p: PcaParams, out: str) -> DataFrame:
    """Mean squared residual of the standardized row after keeping the components.

    The loadings are orthonormal, so the residual is what the components leave of
    the row's squared length.
    """
    k = p.loadings.shape[1]
    length = " + ".join(
        f"({c} - {m!r}D) / {s!r}D * (({c} - {m!r}D) / {s!r}D)"
        for c, m, s in zip(p.columns, p.mean, p.scale)
    )
    staged = apply_pca(df, p, "_pc").withColumn("_len", F.expr(length))
    kept = " + ".join(f"_pc{j} * _pc{j}" for j in range(k))
    error = F.greatest(F.lit(0.0), (F.col("_len") - F.expr(kept)) / float(len(p.columns)))
    return staged.withColumn(out, error).drop("_len", *[f"_pc{j}" for j in range(k)])
