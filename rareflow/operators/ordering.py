"""Global order without a single-task window.

A global order is cut into ranges that are balanced by row count. Each range is
then an ordinary window partition, and one small table of per-range totals (at
most one row per range) carries state from one range to the next. A single key
value that fills several ranges is cut further by the tie-break column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareflow.session import range_count

SUB = 1 << 20
SMALL_GROUP = 100_000
BROADCAST_VALUES = 500_000
PER_CUT = 100
COARSE = 32


def range_bounds(df: DataFrame, key: str, n: int) -> list[float]:
    """Approximate n-quantile cut points of ``key``; a repeated point marks a hot value."""
    probs = [i / n for i in range(1, n)]
    row = df.agg(
        F.percentile_approx(F.col(key).cast("double"), probs, F.lit(max(10000, 20 * n))).alias("q")
    ).first()
    return list(row.q or [])


def assign_range(df: DataFrame, key: str, bounds: Sequence[float], out: str = "_range") -> DataFrame:
    """Binary search of ``key`` in the cut points; range ids grow with the key."""
    cuts = sorted(set(bounds))
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    tmp = f"{out}_key"
    splits = [float("-inf"), *cuts, float("inf")]
    return (
        Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
        .transform(df.withColumn(tmp, F.col(key).cast("double")))
        .drop(tmp)
    )


def ordered_ranges(df: DataFrame, key: str, tie: str, n: int | None = None) -> DataFrame:
    """Adds ``_range`` such that ranges follow the order (key, tie) and are balanced."""
    n = n or range_count(df.sparkSession)
    bounds = range_bounds(df, key, n)
    hot = sorted({b for b, c in zip(bounds, bounds[1:]) if b == c})
    ranged = assign_range(df, key, bounds, "_main")
    sub: Column = F.lit(0)
    if hot:
        probs = [i / n for i in range(1, n)]
        cuts = {
            r.k: sorted(set(r.q))
            for r in df.where(F.col(key).cast("double").isin(hot))
            .groupBy(F.col(key).cast("double").alias("k"))
            .agg(F.percentile_approx(tie, probs, F.lit(max(10000, 20 * n))).alias("q"))
            .collect()
        }
        sub = F.lit(n + 1)
        for value, edges in cuts.items():
            inner = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col(tie)))
            sub = F.when(F.col(key).cast("double") == F.lit(value), inner).otherwise(sub)
    return ranged.withColumn("_range", F.col("_main").cast("long") * SUB + sub).drop("_main")


def _locate(x: Column, cuts: Column, coarse: Column) -> Column:
    """How many cut points are <= x: first among every ``COARSE``-th, then inside one block."""
    block = F.size(F.filter(coarse, lambda c: c <= x))
    fine = F.slice(cuts, (block - 1) * COARSE + 1, F.lit(COARSE))
    return F.when(block == 0, F.lit(0)).otherwise(
        (block - 1) * COARSE + F.size(F.filter(fine, lambda c: c <= x))
    )


def grouped_ranges(
    df: DataFrame, order: Sequence[str], by: Sequence[str], n: int, total: int
) -> DataFrame:
    """Adds ``_range`` inside each group, so that no (group, range) holds much over 1/n of all rows.

    Cut points are every ``PER_CUT``-th row of a small hashed sample of the group's
    rows; the sample has about ``PER_CUT`` * n rows in all. Small groups get no cut
    points and stay whole. Ranges follow ``order``, ties included.
    """
    every = max(1, total // (PER_CUT * n))
    point = F.struct(*order)
    sample = df.where(F.pmod(F.xxhash64(*by, *order), F.lit(every)) == 0)
    cuts = (
        sample.groupBy(*by)
        .agg(F.sort_array(F.collect_list(point)).alias("_s"))
        .select(*by, F.filter("_s", lambda x, i: i % PER_CUT == PER_CUT - 1).alias("_cuts"))
        .where(F.size("_cuts") > 0)
        .withColumn("_coarse", F.filter("_cuts", lambda x, i: i % COARSE == 0))
    )
    at = _locate(point, F.col("_cuts"), F.col("_coarse"))
    return (
        df.join(F.broadcast(cuts), list(by), "left")  # at most n groups have cut points
        .withColumn("_range", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(at).cast("bigint"))
        .drop("_cuts", "_coarse")
    )


def _with_ranges(df: DataFrame, order: str, by: Sequence[str], n: int, small: int) -> DataFrame | None:
    """Adds ``_range``; None when the whole input is small enough for one task."""
    if by:
        total = df.count()
        return None if total <= small else grouped_ranges(df, [order], by, n, total)
    probs = [i / n for i in range(1, n)]
    row = df.agg(
        F.count(F.lit(1)).alias("c"),
        F.percentile_approx(F.col(order).cast("double"), probs, F.lit(max(10000, 20 * n))).alias("q"),
    ).first()
    return None if row.c <= small else assign_range(df, order, row.q)


def prefix_sums(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    n: int | None = None,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """Running totals (current row included) of one-row-per-value data in ``order``.

    ``df`` must already hold one row per (by, order) value: grouping first folds
    hot values into one row on the map side.
    """
    n = n or range_count(df.sparkSession)
    step = F.col(order).desc() if descending else F.col(order).asc()
    keep = [c for c in df.columns if c not in sums]
    ranged = _with_ranges(df, order, by, n, small)
    if ranged is None:
        whole = Window.partitionBy(*by).orderBy(step).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return df.select(*keep, *[F.sum(c).over(whole).alias(o) for o, c in sums.items()])
    if descending:
        ranged = ranged.withColumn("_range", -F.col("_range"))
    inside = Window.partitionBy(*by, "_range").orderBy(step).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, "_range")
        .agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
        .select(
            *by,
            "_range",
            *[F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_o_{o}") for o in sums],
        )
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most one row per range
    running = ranged.select(
        *keep, "_range", *[F.sum(c).over(inside).alias(f"_r_{o}") for o, c in sums.items()]
    )
    return running.join(offsets, [*by, "_range"]).select(
        *keep, *[(F.col(f"_r_{o}") + F.col(f"_o_{o}")).alias(o) for o in sums]
    )


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def average_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), small: int = SMALL_GROUP
) -> DataFrame:
    """One row per value: ``n`` rows share it and ``rank`` is their mean 1-based rank."""
    return ranks_of_counts(value_counts(df, value, by), value, by, small)


def ranks_of_counts(counts: DataFrame, value: str, by: Sequence[str] = (), small: int = SMALL_GROUP) -> DataFrame:
    """``average_ranks`` from the counts of the values, which are read several times."""
    cum = prefix_sums(counts.withColumn("cum", F.col("n")), value, {"cum": "cum"}, by, small=small)
    return cum.withColumn("rank", F.col("cum") - F.col("n") + (F.col("n") + 1) / 2.0)


def fits_broadcast(df: DataFrame, value: str, limit: int = BROADCAST_VALUES) -> bool:
    """Whether a table with one row per distinct value is small enough to broadcast."""
    return df.agg(F.approx_count_distinct(value)).first()[0] <= limit


def lookup_by_value(
    df: DataFrame, looked_up: DataFrame, value: str, total: int, share: int = 1000,
    broadcast: bool = False,
) -> DataFrame:
    """Join per-value results (with their row count ``n``) back to the rows.

    ``broadcast`` is for a ``looked_up`` whose size was checked. Otherwise only the
    values holding more than 1/share of the rows, fewer than ``share`` of them, are
    broadcast, so no task receives a hot value; the rest is an ordinary join in which
    every value is small.
    """
    if broadcast:
        return df.join(F.broadcast(looked_up), value)
    limit = F.lit(max(1, total // share))
    hot = F.broadcast(looked_up.where(F.col("n") > limit))
    cold = looked_up.where(F.col("n") <= limit)
    return df.join(hot, value).unionByName(
        df.join(hot.select(value), value, "left_anti").join(cold, value)
    )
