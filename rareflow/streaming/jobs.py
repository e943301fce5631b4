"""Streaming jobs: windowed counts and rates, quality, drift, sessions and rolling state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.operators import evaluation as ev
from rareflow.operators.drift import EPS, Bins
from rareflow.streaming.state import RollingRows, rolling_schema

DELAY = "10 minutes"
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def watermarked(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    return stream.withWatermark("event_time", delay)


def _start(c: str = "w") -> Column:
    return F.unix_seconds(F.col(f"{c}.start")).alias("window_start")


def hourly_counts(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    return (
        watermarked(stream, delay).groupBy(F.window("event_time", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("pred").alias("flagged"))
        .select(_start(), "n", "flagged")
    )


def flagged_rate(stream: DataFrame, size: str = "5 minutes", slide: str = "1 minute", delay: str = DELAY) -> DataFrame:
    return (
        watermarked(stream, delay).groupBy(F.window("event_time", size, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), (F.avg("pred") * 100).alias("flagged_pct"))
        .select(_start(), "n", "flagged_pct")
    )


def windowed_quality(stream: DataFrame, size: str = "1 day", delay: str = DELAY) -> DataFrame:
    rows = watermarked(stream.withColumn("label", F.col("Class")), delay).withColumn(
        "w", F.window("event_time", size)
    )
    cells = ev.confusion(rows, ["w"])
    return ev.basic_metrics(cells).select(_start(), "n", "accuracy", "precision", "recall")


#: Size of the latency sketches: their normalised rank error stays well below ``RANK_ERROR``.
SKETCH_K, RANK_ERROR = 1000, 0.01


def latency_sketches(stream: DataFrame, size: str = "1 hour", delay: str = DELAY) -> DataFrame:
    """A mergeable quantile sketch of the amount, a stand-in latency, for every window."""
    return (
        watermarked(stream, delay).groupBy(F.window("event_time", size).alias("w"))
        .agg(F.kll_sketch_agg_double("Amount", F.lit(SKETCH_K)).alias("sketch"), F.count(F.lit(1)).alias("n"))
        .select(_start(), "n", "sketch")
    )


def merged_latency(sketches: DataFrame, seconds: int = 86400) -> DataFrame:
    """p50, p95 and p99 of longer windows from the sketches of shorter ones, whose rows are not read again."""
    start = (F.floor(F.col("window_start") / seconds) * seconds).cast("bigint")
    merged = sketches.groupBy(start.alias("window_start")).agg(
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"), F.sum("n").alias("n")
    )
    at = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in QUANTILES.items()}
    return merged.select("window_start", "n", *at.values())


def windowed_psi(
    stream: DataFrame, bins: Mapping[str, Bins], shares: Mapping[str, Sequence[float]],
    size: str = "1 day", delay: str = DELAY,
) -> DataFrame:
    """PSI of every window against fixed reference shares, one row per feature.

    All bin counts of a window sit in one aggregate row, so the PSI itself is a
    projection and needs no second state.
    """
    counts = [
        F.count_if(b.of(F.col(c)) == i).alias(f"{c}_{i}") for c, b in bins.items() for i in range(b.count)
    ]
    wide = watermarked(stream, delay).groupBy(F.window("event_time", size).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), *counts
    )

    def psi(c, b):
        total = F.lit(0.0)
        for i in range(b.count):
            r = F.lit(max(float(shares[c][i]), EPS))
            x = F.greatest(F.col(f"{c}_{i}") / F.col("n"), F.lit(EPS))
            total = total + (x - r) * F.ln(x / r)
        return total

    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), psi(c, b).alias("psi")) for c, b in bins.items()]
    )
    return wide.select(_start(), F.inline(rows))


def sessions(stream: DataFrame, gap: str = "30 minutes", delay: str = DELAY) -> DataFrame:
    return (
        watermarked(stream, delay)
        .groupBy("user_id", F.session_window("event_time", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("amount"))
        .select("user_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n", "amount")
    )


def deduplicated(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["txn_id"])


def user_rolling(stream: DataFrame, sizes: Sequence[int] = (3, 10), delay: str = DELAY) -> DataFrame:
    """Rolling features of every user's last rows, in event-time order, as keyed state.

    A row's result leaves once the watermark has passed the row. Only users with new or
    due rows are read and written in a micro-batch. Needs a state store with column
    families (``sources.keyed_state``). One user's rows are worked on in one task.
    """
    rows = watermarked(stream, delay).select(
        "user_id", "event_time", F.unix_micros("event_time").alias("event_us"), "txn_id", "Amount", "Class"
    )
    return rows.groupBy("user_id").transformWithStateInPandas(
        RollingRows(sizes), rolling_schema(sizes), outputMode="append", timeMode="eventTime"
    )
