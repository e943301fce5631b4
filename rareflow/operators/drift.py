"""Distribution drift between a reference and a current table.

All features are handled together: bins and values become long rows that are
partially aggregated before the shuffle, so the number of jobs does not depend
on the number of features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.bands import drift_severity
from rareflow.functions.shape import edge_codes, numeric_columns, stats_by_feature
from rareflow.operators.ordering import prefix_sums
from rareflow.operators.quantiles import exact_quantiles

EPS = 1e-10
KS_ALPHA = 0.05


def common_features(ref: DataFrame, cur: DataFrame, skip: Sequence[str] = ("Class", "txn_id", "user_id")) -> list[str]:
    have = set(cur.columns)
    return [c for c in numeric_columns(ref, skip) if c in have]


def mean_std_shift(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    stats = {"mean": F.avg, "std": F.stddev_samp}
    a = stats_by_feature(ref, cols, stats).withColumnsRenamed({"mean": "ref_mean", "std": "ref_std"})
    b = stats_by_feature(cur, cols, stats).withColumnsRenamed({"mean": "cur_mean", "std": "cur_std"})

    def shift(x):
        r, c = F.col(f"ref_{x}"), F.col(f"cur_{x}")
        return F.abs(c - r) / (F.abs(r) + F.lit(EPS)) * 100

    return a.join(b, "feature").withColumns(
        {"mean_diff_pct": shift("mean"), "std_diff_pct": shift("std")}
    )


@dataclass(frozen=True)
class Bins:
    lo: float
    hi: float
    count: int

    def of(self, x: Column) -> Column:
        """Equal-width bin number, the last bin closed."""
        if self.hi == self.lo:
            return F.when(x.isNotNull(), F.lit(0))
        width = (self.hi - self.lo) / self.count
        inner = F.floor((x - F.lit(self.lo)) / F.lit(width))
        return F.least(F.lit(self.count - 1), F.greatest(F.lit(0), inner)).cast("int")


def fit_bins(ref: DataFrame, cur: DataFrame, cols: Sequence[str], most: int = 10) -> dict[str, Bins]:
    """Combined range, and as many bins as distinct values up to ``most``.

    A sketch decides which columns may have fewer than ``most`` values; only those
    are counted exactly, where the set of values is tiny.
    """
    both = ref.select(*cols).unionByName(cur.select(*cols))
    row = both.agg(
        *[F.min(c).alias(f"lo_{c}") for c in cols],
        *[F.max(c).alias(f"hi_{c}") for c in cols],
        *[F.approx_count_distinct(c).alias(f"d_{c}") for c in cols],
    ).first()
    few = [c for c in cols if row[f"d_{c}"] < 10 * most]
    exact = {}
    if few:
        r = both.agg(*[F.count_distinct(c).alias(c) for c in few]).first()
        exact = {c: r[c] for c in few}
    return {
        c: Bins(row[f"lo_{c}"], row[f"hi_{c}"], max(1, min(most, exact.get(c, most)))) for c in cols
    }


def _bin_rows(df: DataFrame, bins: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), b.alias("bin")) for c, b in bins.items()]
    )
    return df.select(*by, F.inline(rows)).where(F.col("bin").isNotNull())


def bin_counts(df: DataFrame, bins: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    return _bin_rows(df, bins, by).groupBy(*by, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def _shares(ref: DataFrame, cur: DataFrame, ref_n: int, cur_n: int, keys: Sequence[str]) -> DataFrame:
    """Aligned shares of both sides; a bin missing on one side has share 0."""
    zero = F.lit(0).cast("bigint")
    both = ref.select(*keys, F.col("n").alias("r"), zero.alias("c")).unionByName(
        cur.select(*keys, zero.alias("r"), F.col("n").alias("c"))
    )
    return both.groupBy(*keys).agg(
        (F.sum("r") / F.lit(float(ref_n))).alias("ref_share"),
        (F.sum("c") / F.lit(float(cur_n))).alias("cur_share"),
    )


def psi_sum(ref_share="ref_share", cur_share="cur_share") -> Column:
    r = F.greatest(F.col(ref_share), F.lit(EPS))
    c = F.greatest(F.col(cur_share), F.lit(EPS))
    return F.sum((c - r) * F.ln(c / r))


def js_distance(ref_share="ref_share", cur_share="cur_share") -> Column:
    r = F.greatest(F.col(ref_share), F.lit(EPS))
    c = F.greatest(F.col(cur_share), F.lit(EPS))
    m = (r + c) / 2.0
    return F.sqrt(F.sum((r * F.ln(r / m) + c * F.ln(c / m)) / 2.0))


def binned_shares(ref: DataFrame, cur: DataFrame, cols: Sequence[str], bins: Mapping[str, Bins] | None = None) -> DataFrame:
    bins = bins or fit_bins(ref, cur, cols)
    exprs = {c: bins[c].of(F.col(c)) for c in cols}
    return _shares(
        bin_counts(ref, exprs), bin_counts(cur, exprs), ref.count(), cur.count(), ["feature", "bin"]
    )


def psi_equal_width(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    return binned_shares(ref, cur, cols).groupBy("feature").agg(psi_sum().alias("psi"))


def psi_deciles(ref: DataFrame, cur: DataFrame, cols: Sequence[str], buckets: int = 10) -> DataFrame:
    """Right-closed bins on the reference quantiles; the outer bins are open."""
    edges = exact_quantiles(ref, {c: F.col(c) for c in cols}, [i / buckets for i in range(1, buckets)])
    exprs = {c: F.col(f"_code_{c}") for c in cols}

    def counts(df):
        return bin_counts(edge_codes(df.select(*cols), edges), exprs)

    shares = _shares(counts(ref), counts(cur), ref.count(), cur.count(), ["feature", "bin"])
    return shares.groupBy("feature").agg(psi_sum().alias("psi"))


def psi_categorical(ref: DataFrame, cur: DataFrame, column: str) -> DataFrame:
    def counts(df):
        return df.groupBy(F.col(column).alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    shares = _shares(counts(ref), counts(cur), ref.count(), cur.count(), ["bin"])
    return shares.agg(F.lit(column).alias("feature"), psi_sum().alias("psi"))


def ks_p_value(stat: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample tail: 2 * sum (-1)^(k-1) exp(-2 k^2 x^2), x = d sqrt(nm/(n+m))."""
    x = stat * F.sqrt(n.cast("double") * m / (n + m))
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda a, k: a
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * x * x),
    )
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def ks_two_sample(ref: DataFrame, cur: DataFrame, cols: Sequence[str], alpha: float = KS_ALPHA) -> DataFrame:
    """Largest gap between the two running shares, per feature."""

    def long(df, r, c):
        rows = F.array(
            *[F.struct(F.lit(x).alias("feature"), F.col(x).cast("double").alias("value")) for x in cols]
        )
        return df.select(F.inline(rows), F.lit(r).alias("r"), F.lit(c).alias("c")).where(
            F.col("value").isNotNull()
        )

    grouped = (
        long(ref, 1, 0).unionByName(long(cur, 0, 1))
        .groupBy("feature", "value")
        .agg(F.sum("r").alias("cum_r"), F.sum("c").alias("cum_c"))
    )
    run = prefix_sums(grouped, "value", {"cum_r": "cum_r", "cum_c": "cum_c"}, ["feature"])
    sizes = stats_by_feature(ref, cols, {"n_ref": F.count}).join(
        stats_by_feature(cur, cols, {"n_cur": F.count}), "feature"
    )
    gap = F.abs(F.col("cum_r") / F.col("n_ref") - F.col("cum_c") / F.col("n_cur"))
    stat = run.join(F.broadcast(sizes), "feature").groupBy("feature", "n_ref", "n_cur").agg(
        F.max(gap).alias("ks_stat")
    )
    p = ks_p_value(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur"))
    return stat.select("feature", "ks_stat", p.alias("ks_p_value")).withColumn(
        "drift_detected_ks", F.col("ks_p_value") < F.lit(alpha)
    )


def drift_report(
    ref: DataFrame, cur: DataFrame, features: Sequence[str] | None = None,
    minor: float = 0.1, major: float = 0.25, alpha: float = KS_ALPHA,
) -> DataFrame:
    cols = [c for c in (features or common_features(ref, cur)) if c in ref.columns and c in cur.columns]
    psi = psi_equal_width(ref, cur, cols).withColumn(
        "drift_severity_psi", drift_severity("psi", minor, major)
    )
    return (
        mean_std_shift(ref, cur, cols)
        .join(psi, "feature")
        .join(ks_two_sample(ref, cur, cols, alpha), "feature")
    )


def drift_verdict(report: DataFrame) -> DataFrame:
    """Whether anything drifted, and which features did (one entry per feature)."""
    drifted = (F.col("drift_severity_psi") != "No drift") | F.col("drift_detected_ks")
    return report.agg(
        F.bool_or(drifted).alias("drift_detected"),
        F.count(F.lit(1)).alias("features_checked"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(drifted, F.col("feature")))), ","
        ).alias("drifted_features"),
    )


def grouped_psi(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], group: str
) -> DataFrame:
    """PSI of every group of ``cur`` (for example a week) against the whole reference."""
    bins = fit_bins(ref, cur, cols)
    exprs = {c: bins[c].of(F.col(c)) for c in cols}
    r = bin_counts(ref, exprs).select("feature", "bin", (F.col("n") / F.lit(float(ref.count()))).alias("ref_share"))
    sizes = cur.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    grid = sizes.select(
        group, "_size",
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.lit(i).alias("bin"))
            for c, b in bins.items()
            for i in range(b.count)
        ])),
    )
    counts = bin_counts(cur, exprs, [group])
    return (
        grid.join(counts, [group, "feature", "bin"], "left")
        .join(F.broadcast(r), ["feature", "bin"], "left")  # features x bins rows
        .select(
            group, "feature",
            F.coalesce("ref_share", F.lit(0.0)).alias("ref_share"),
            (F.coalesce("n", F.lit(0)) / F.col("_size")).alias("cur_share"),
        )
        .groupBy(group, "feature").agg(psi_sum().alias("psi"))
    )
