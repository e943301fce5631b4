"""Wide-to-long reshaping of aggregates."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

V_COLS = [f"V{i}" for i in range(1, 29)]


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in df.dtypes if c not in skip and (t in kinds or t.startswith("decimal"))]


def stats_by_feature(
    df: DataFrame,
    cols: Sequence[str],
    stats: Mapping[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """One wide aggregate over ``df`` turned into one row per feature.

    The table is never exploded: only the aggregated row is.
    """
    aggs = [fn(F.col(c)).alias(f"{c}__{s}") for c in cols for s, fn in stats.items()]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{s}").alias(s) for s in stats])
            for c in cols
        ]
    )
    return wide.select(*by, F.inline(rows))


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows to ``(ids.., feature, value)``; null values are dropped."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), "feature", "value"
    ).where(F.col("value").isNotNull())


def edge_codes(
    df: DataFrame, edges: Mapping[str, Sequence[float]], right_closed: bool = True, prefix: str = "_code_"
) -> DataFrame:
    """Adds, per column, how many distinct edges lie below the value (at or below, if not right-closed).

    A binary search per value keeps the compiled code small however many edges there are.
    """
    names = list(edges)
    cuts = {c: sorted({math.nextafter(e, math.inf) if right_closed else e for e in edges[c]}) for c in names}
    doubles = df.withColumns({f"{prefix}{c}_in": F.col(c).cast("double") for c in names})
    coded = Bucketizer(
        splitsArray=[[-math.inf, *cuts[c], math.inf] for c in names],
        inputCols=[f"{prefix}{c}_in" for c in names],
        outputCols=[f"{prefix}{c}_out" for c in names],
        handleInvalid="keep",
    ).transform(doubles)
    return coded.select(
        *df.columns, *[F.col(f"{prefix}{c}_out").cast("int").alias(f"{prefix}{c}") for c in names]
    )
