"""Feature scores and filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareflow.functions.shape import edge_codes, stats_by_feature
from rareflow.operators.ordering import BROADCAST_VALUES, fits_broadcast, lookup_by_value, prefix_sums, ranks_of_counts, value_counts
from rareflow.operators.profile import correlation_matrix
from rareflow.operators.quantiles import exact_quantiles
from rareflow.session import shared_dir, stored

#: About so many value pairs are counted together, up to so many ranges; their grid has the square of those cells at most.
CELLS = 100_000
MOST_RANGES = 512


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return stats_by_feature(df, cols, {"variance": F.var_pop})


def low_variance_filter(df: DataFrame, cols: Sequence[str], threshold: float = 0.01) -> DataFrame:
    return variances(df, cols).withColumn("kept", F.col("variance") > F.lit(threshold))


def greedy_correlation_drop(
    cols: Sequence[str], corr, variance: Mapping[str, float], threshold: float = 0.95
) -> list[str]:
    """For each pair above the threshold, drop the lower-variance column, also if one is dropped already."""
    dropped: set[str] = set()
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            b = cols[j]
            if abs(corr[i][j]) > threshold:
                dropped.add(a if variance[a] < variance[b] else b)
    return [c for c in cols if c not in dropped]


def correlation_filter(
    df: DataFrame, cols: Sequence[str], threshold: float = 0.95, method: str = "pearson"
) -> list[str]:
    cols = list(cols)
    if method == "pearson":
        m = correlation_matrix(df, cols)
    else:
        pairs = spearman_pairs(df, cols) if method == "spearman" else kendall_pairs(df, cols)
        at = {c: i for i, c in enumerate(cols)}
        m = [[1.0 if i == j else 0.0 for j in range(len(cols))] for i in range(len(cols))]
        for r in pairs.collect():
            i, j = at[r.left], at[r.right]
            m[i][j] = m[j][i] = r.corr
    var = {r.feature: r.variance for r in variances(df, cols).collect()}
    return greedy_correlation_drop(cols, m, var, threshold)


def _pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]


def spearman_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of average ranks, over the rows in which both columns are not null.

    A column without nulls has one ranking beside the others without; where a pair has
    nulls, both columns are ranked among the rows that the pair shares. All rankings are
    worked out together: values fold to counts of (ranking, value), and these are cut
    into ranges that carry their totals on. Hot values never reach one task.
    """
    cols = list(cols)
    spark = df.sparkSession
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count(c).alias(c) for c in cols]).first()
    holey = {c for c in cols if counts[c] < counts["_all"]}
    rankings: dict[tuple[str, str | None], int] = {}
    for a, b in _pairs(cols):
        shared = a in holey or b in holey
        for c, other in ((a, b), (b, a)):
            rankings.setdefault((c, other if shared else None), len(rankings))
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    rows = stored(rows, "rows-to-rank")
    each = [
        F.struct(F.lit(i).alias("ranking"), (F.col(c) if o is None else F.when(F.col(o).isNotNull(), F.col(c))).alias("value"))
        for (c, o), i in rankings.items()
    ]
    long = rows.select(F.inline(F.array(*each))).where(F.col("value").isNotNull())
    held = stored(value_counts(long, "value", ["ranking"]), "value-counts")
    ranks = stored(ranks_of_counts(held, "value", ["ranking"]).select("ranking", "value", "n", "rank"), "ranks")
    wide = _with_ranks(rows, ranks, rankings, counts["_all"])
    of = {
        (a, b): tuple(rankings[c, o if a in holey or b in holey else None] for c, o in ((a, b), (b, a)))
        for a, b in _pairs(cols)
    }
    row = wide.agg(*[F.corr(f"_{i}", f"_{j}").alias(f"{a}__{b}") for (a, b), (i, j) in of.items()]).first()
    return spark.createDataFrame(
        [(a, b, row[f"{a}__{b}"]) for a, b in _pairs(cols)], "left string, right string, corr double"
    )


def _with_ranks(rows: DataFrame, ranks: DataFrame, rankings: Mapping[tuple[str, str | None], int], total: int) -> DataFrame:
    """Adds ``_i``, the rank in ranking i, with one join a column for all its rankings.

    A column of many values is joined on the value, hot values apart, and the rows are
    written out after it; the table of any other is broadcast, its size checked.
    """
    tables = {}
    for c in dict.fromkeys(c for c, _ in rankings):
        mine = [i for (x, _), i in rankings.items() if x == c]
        each = [F.max(F.when(F.col("ranking") == i, F.col("rank"))).alias(f"_{i}") for i in mine]
        of = ranks.where(F.col("ranking").isin(mine)).groupBy(F.col("value").alias(c)).agg(F.max("n").alias("n"), *each)
        of = stored(of, "column-ranks")
        tables[c] = of.count(), of
    for c, (size, of) in sorted(tables.items(), key=lambda x: -x[1][0]):
        if size <= BROADCAST_VALUES:
            rows = rows.join(F.broadcast(of.drop("n")), c, "left")
        else:
            known = lookup_by_value(rows.where(F.col(c).isNotNull()), of, c, total).drop("n")
            none = rows.where(F.col(c).isNull())
            rows = stored(known.unionByName(none, allowMissingColumns=True), "ranked-rows")
    shared = {f"_{i}": F.when(F.col(o).isNotNull(), F.col(f"_{i}")) for (_, o), i in rankings.items() if o is not None}
    return rows.withColumns(shared) if shared else rows


def _with_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns as the dense ranks of their values from 0, null for null.

    As for ``spearman_pairs`` the table is written out after a column of many values.
    """
    total = df.count()
    coded = df.select(*cols)
    for c in cols:
        counts = stored(value_counts(df, c).withColumn("one", F.lit(1).cast("long")), "value-counts")
        ranks = prefix_sums(counts, c, {"one": "one"}).select(c, "n", (F.col("one") - 1).alias(f"_code_{c}"))
        if fits_broadcast(df, c):
            coded = coded.join(F.broadcast(ranks.drop("n")), c, "left")
        else:
            known = lookup_by_value(coded.where(F.col(c).isNotNull()), ranks, c, total).drop("n")
            none = coded.where(F.col(c).isNull()).withColumn(f"_code_{c}", F.lit(None).cast("long"))
            shared_dir(df.sparkSession)
            coded = known.unionByName(none).checkpoint()
    return coded.select(*[F.col(f"_code_{c}").alias(c) for c in cols])


def pair_counter() -> Callable[[np.ndarray, np.ndarray, np.ndarray], int]:
    """The count of ``kendall_pairs``, as a function that travels to the tasks without this module."""

    def concordant(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> int:
        """How many pairs have the smaller x and the smaller y in the same row; row i stands for n[i] rows.

        Two different ranks of x part at one bit: they agree above it, and the smaller has a
        zero there. So for every bit, running sums along y over the zeros of the ranks that
        agree above it count the pairs once.
        """
        x, y = (np.unique(v, return_inverse=True)[1] for v in (x, y))
        x, y = (x, y) if x.max() <= y.max() else (y, x)
        order = np.argsort(y, kind="stable")
        x, y, n = x[order], y[order], n[order].astype(np.int64)
        places, found = np.arange(len(x)), 0
        for bit in range(int(x.max()).bit_length()):
            at = np.argsort(x >> (bit + 1), kind="stable")
            above, along, one, m = (x >> (bit + 1))[at], y[at], ((x >> bit) & 1)[at] == 1, n[at]
            zeros = np.where(one, 0, m)
            before = np.cumsum(zeros) - zeros
            opens = np.r_[True, above[1:] != above[:-1]]
            ties = opens | np.r_[True, along[1:] != along[:-1]]
            block, tie = (np.maximum.accumulate(np.where(f, places, 0)) for f in (opens, ties))
            found += int((before[tie] - before[block])[one] @ m[one])
        return found

    return concordant


def _range_cuts(cells: DataFrame) -> dict[int, dict[str, np.ndarray]]:
    """By pair, where the ranges of x and y open that hold about ``CELLS`` cells; a hot value has a range of its own."""
    most = max([r["count"] for r in cells.groupBy("pair").count().collect()], default=0)
    n = min(MOST_RANGES, -(-most // CELLS))
    if n <= 1:
        return {}
    probs = [i / n for i in range(1, n)]
    found = cells.groupBy("pair").agg(*[F.percentile_approx(c, probs, F.lit(max(10000, 20 * n))).alias(c) for c in "xy"])
    return {
        r.pair: {
            c: np.array(sorted({*r[c], *[v + 1 for v, w in zip(r[c], r[c][1:]) if v == w]}), dtype=np.int64) for c in "xy"
        }
        for r in found.collect()
    }


def _with_ranges(cells: DataFrame) -> DataFrame:
    """Adds the range of x and of y, and whether that range holds one value alone."""
    cuts = _range_cuts(cells)

    def place(frames):
        for f in frames:
            for c in "xy":
                f[f"{c}_range"], f[f"{c}_alone"] = 0, False
                for pair in f["pair"].unique():
                    if pair in cuts:
                        at = cuts[pair][c]
                        mine = f["pair"] == pair
                        part = np.searchsorted(at, f.loc[mine, c], side="right")
                        f.loc[mine, f"{c}_range"] = part
                        f.loc[mine, f"{c}_alone"] = np.r_[False, np.diff(at) == 1, False][part]
            yield f

    schema = "pair int, x bigint, y bigint, n bigint, x_range bigint, x_alone boolean, y_range bigint, y_alone boolean"
    return cells.mapInPandas(place, schema)


def kendall_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact tau-b of every pair, over the rows in which both columns are not null.

    Rows fold to counts of value pairs (x, y). Both columns are cut into ranges. Two rows
    are in the same range of y, or else in the same range of x, or in different ranges of
    both: the first are counted in every range of y, the second in every range of x by the
    number of their range of y, the third on the counts of the grid. So a value pair is
    shuffled twice, however many values there are; a range of one value has nothing to count.
    """
    codes = _with_codes(df, cols)
    named = _pairs(cols)
    rows = [F.struct(F.lit(i).alias("pair"), F.col(a).alias("x"), F.col(b).alias("y")) for i, (a, b) in enumerate(named)]
    pairs = codes.select(F.inline(F.array(*rows))).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    cells = stored(pairs.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("n")), "value-pairs")
    ranged = stored(_with_ranges(cells), "ranged-pairs")
    pair, n = F.col("pair"), F.col("n")
    grid = ranged.groupBy("pair", "x_range", "y_range").agg(F.sum("n").alias("n"))
    met = ranged.where(~F.col("y_alone")).select(pair, F.lit(0).alias("kind"), F.col("y_range").alias("part"), "x", "y", n)
    met = met.unionByName(
        ranged.where(~F.col("x_alone")).select(pair, F.lit(1).alias("kind"), F.col("x_range").alias("part"), "x", F.col("y_range").alias("y"), n)
    ).unionByName(
        grid.select(pair, F.lit(2).alias("kind"), F.lit(0).cast("long").alias("part"), F.col("x_range").alias("x"), F.col("y_range").alias("y"), n)
    )

    concordant = pair_counter()

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        found = concordant(*(rows[c].to_numpy() for c in "xyn"))
        return pd.DataFrame({"pair": rows["pair"].iloc[:1], "conc": [float(found)]})

    d = "double"
    conc = met.groupBy("pair", "kind", "part").applyInPandas(count, "pair int, conc double")
    conc = conc.groupBy("pair").agg(F.sum("conc").alias("conc"))
    total = cells.groupBy("pair").agg(F.sum("n").cast(d).alias("total"))

    def ties(by, name):
        m = cells.groupBy("pair", *by).agg(F.sum("n").cast(d).alias("m"))
        return m.groupBy("pair").agg(F.sum(F.col("m") * (F.col("m") - 1) / 2).alias(name))

    out = conc.join(total, "pair").join(ties(["x"], "tx"), "pair").join(ties(["y"], "ty"), "pair").join(ties(["x", "y"], "txy"), "pair")
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(named)], "pair int, left string, right string")
    n0 = F.col("total") * (F.col("total") - 1) / 2
    disc = n0 - F.col("tx") - F.col("ty") + F.col("txy") - F.col("conc")
    tau = F.try_divide(
        F.col("conc") - disc, F.sqrt(n0 - F.col("tx")) * F.sqrt(n0 - F.col("ty"))
    )
    return out.join(F.broadcast(names), "pair").select("left", "right", tau.alias("corr"))


def anova_f(df: DataFrame, cols: Sequence[str], target: str = "Class") -> DataFrame:
    """One-way F statistic of every feature against the class."""
    by_class = stats_by_feature(
        df, cols, {"n": F.count, "m": F.avg, "v": F.var_samp}, [target]
    )
    w = Window.partitionBy("feature")
    n, m, v = F.col("n"), F.col("m"), F.col("v")
    grand = F.sum(n * m).over(w) / F.sum(n).over(w)
    parts = by_class.withColumn("grand", grand)
    sums = parts.groupBy("feature").agg(
        F.sum(n * (m - F.col("grand")) * (m - F.col("grand"))).alias("between"),
        F.sum((n - 1) * F.coalesce(v, F.lit(0.0))).alias("within"),
        F.count(F.lit(1)).alias("k"),
        F.sum(n).alias("total"),
    )
    f = F.try_divide(
        F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("total") - F.col("k"))
    )
    return sums.select("feature", f.alias("f_score"))


def mutual_information(
    df: DataFrame, cols: Sequence[str], target: str = "Class", buckets: int = 10
) -> DataFrame:
    """Mutual information (nats) between quantile bins and the class."""
    q = exact_quantiles(df, {c: F.col(c) for c in cols}, [i / buckets for i in range(1, buckets)])

    coded = edge_codes(df.select(target, *cols), {c: q[c] for c in cols})
    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"_code_{c}").alias("bin")) for c in cols]
    )
    cells = coded.select(target, F.inline(rows)).groupBy("feature", "bin", target).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("feature"))
    of_bin = F.sum("n").over(Window.partitionBy("feature", "bin"))
    of_class = F.sum("n").over(Window.partitionBy("feature", target))
    term = F.col("n") / total * F.ln(F.col("n") * total / (of_bin * of_class))
    return cells.withColumn("term", term).groupBy("feature").agg(
        F.sum("term").alias("mutual_information")
    )


def rank_features(scores: DataFrame, score: str = "score") -> DataFrame:
    """1-based rank, highest score first (one row per feature)."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.col(score).desc(), "feature")
    return scores.withColumn("rank", F.row_number().over(w).cast("bigint"))


def select_k_best(scores: DataFrame, score: str, k: int) -> DataFrame:
    return scores.orderBy(F.col(score).desc(), "feature").limit(k)


def vote(selections: Mapping[str, Sequence[str]], spark, share: float = 0.5) -> DataFrame:
    """Features named by at least int(methods * share) methods."""
    rows = [(m, f) for m, names in selections.items() for f in names]
    need = int(len(selections) * share)
    return (
        spark.createDataFrame(rows, "method string, feature string")
        .groupBy("feature").agg(F.count(F.lit(1)).alias("votes"))
        .where(F.col("votes") >= need)
    )
