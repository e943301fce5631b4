"""Row-count windows over a global time order, and their per-entity form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rareflow.operators.ordering import grouped_ranges, ordered_ranges
from rareflow.session import range_count

SMALL_ROWS = 20_000


def window_features(w: WindowSpec, size: int, lag: int, value: str, target: str) -> dict[str, Column]:
    """Mean, std, row count and positive rate over the last ``size`` rows.

    With ``lag`` 1 the positive rate looks only at earlier rows, so it does not see
    the label it will be used to predict.
    """
    now = w.rowsBetween(-(size - 1), 0)
    label = w.rowsBetween(-(size - 1) - lag, -lag) if lag else now
    n = F.count(F.lit(1)).over(now)
    return {
        f"{value}_rolling_mean_{size}": F.avg(value).over(now),
        f"{value}_rolling_std_{size}": F.when(n > 1, F.stddev_samp(value).over(now)),
        f"velocity_{size}": n,
        f"positive_rate_rolling_{size}": F.avg(target).over(label),
    }


def _all_sizes(w, sizes, lag, value, target) -> dict[str, Column]:
    out = {}
    for s in sizes:
        out.update(window_features(w, s, lag, value, target))
    return out


def rolling(
    df: DataFrame, sizes: Sequence[int] = (10, 50, 100), lag: int = 0, by: Sequence[str] = (),
    time: str = "Time", key: str = "txn_id", value: str = "Amount", target: str = "Class",
    n: int | None = None, small: int = SMALL_ROWS,
) -> DataFrame:
    """Rolling features in (time, key) order, over the whole table or inside each ``by`` group.

    The order is cut into balanced ranges; each range also receives the last rows
    before it (the halo), so its own window sees everything it needs. Halo rows are
    dropped afterwards. Groups that fit one range pass through uncut.
    """
    by = list(by)
    total = df.count()
    if total <= small:
        w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(time, key)
        return df.withColumns(_all_sizes(w, sizes, lag, value, target))
    n = n or range_count(df.sparkSession)
    ranged = (
        grouped_ranges(df, [time, key], by, n, total) if by else ordered_ranges(df, time, key, n)
    )
    reach = max(sizes) - 1 + lag
    to = halo_links(ranged, by, reach)
    # only ranges that some later range looks back to take part, with their narrow columns
    tail = Window.partitionBy(*by, "_range", "_to").orderBy(F.col(time).desc(), F.col(key).desc())
    narrow = ranged.select(*by, *{time, key, value, target} - set(by), "_range")
    halo = (
        narrow.join(F.broadcast(to), [*by, "_range"])  # about one link per range of a cut group
        .withColumn("_back", F.row_number().over(tail))
        .where((F.col("_back") <= reach) & (F.col("_back") <= F.col("_need")))
        .drop("_range", "_back", "_need")
        .withColumnRenamed("_to", "_range")
        .withColumn("_halo", F.lit(True))
    )
    both = ranged.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(*by, "_range").orderBy(time, key)
    return (
        both.withColumns(_all_sizes(w, sizes, lag, value, target))
        .where(~F.col("_halo"))
        .drop("_halo", "_range")
    )


def halo_links(ranged: DataFrame, by: Sequence[str], reach: int) -> DataFrame:
    """(from range, to range, rows needed): which tails each range needs to look back ``reach`` rows.

    A range takes the tail of the range before it, and of earlier ones while those
    hold fewer rows than it still needs.
    """
    sizes = ranged.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range")
    cum = sizes.select(
        *by, "_range", "c",
        F.sum("c").over(w).alias("end"),
        F.collect_list(F.struct(F.col("_range").alias("r"), F.col("c").alias("c"))).over(
            w.rowsBetween(-reach, -1)
        ).alias("earlier"),
    )
    # rows that lie between an earlier range and this one
    steps = cum.where(F.size("earlier") > 0).select(
        *by, F.col("_range").alias("_to"), F.posexplode("earlier").alias("i", "e"), "earlier"
    )
    between = F.aggregate(
        F.slice("earlier", F.col("i") + 2, F.size("earlier")),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x["c"],
    )
    return (
        steps.withColumn("_need", F.lit(reach) - between)
        .where(F.col("_need") > 0)
        .select(*by, F.col("e.r").alias("_range"), "_to", "_need")
    )
