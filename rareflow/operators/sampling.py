"""Exact-size splits, folds and samples without a global sort.

Rows are ordered by an integer permutation of their key. The permutation is
uniform, so fixed slices of it have near-equal sizes. Counting rows per slice
locates the slice of each cut; only that slice is then ranked to get the exact
cut row. Assigning rows to parts afterwards is a comparison, not a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareflow.functions.keys import KEY_SPACE, perm_key, unit_draw

SLICES = 4096
SLICE_WIDTH = KEY_SPACE // SLICES


def class_sizes(df: DataFrame, target: str) -> dict[int, int]:
    return {r[target]: r.n for r in df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()}


def slice_counts(df: DataFrame, strata: Column, key: str, seed: int) -> DataFrame:
    """Rows per (stratum, slice): at most ``SLICES`` rows per stratum."""
    return (
        df.groupBy(strata.alias("s"), F.floor(perm_key(key, seed) / SLICE_WIDTH).alias("slice"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cut_rows(
    df: DataFrame, strata: Column, cuts: dict[object, Sequence[int]], key: str, seed: int
) -> dict[tuple[object, int], tuple[int, int]]:
    """The (permutation key, row key) of the cut-th row of each stratum, cuts counted from 0."""
    located: dict[tuple[object, int], list[tuple[int, int]]] = {}
    seen: dict[object, int] = {}
    for r in slice_counts(df, strata, key, seed).orderBy("s", "slice").collect():
        start = seen.get(r.s, 0)
        seen[r.s] = start + r.n
        for c in cuts.get(r.s, ()):
            if start <= c < start + r.n:
                located.setdefault((r.s, r.slice), []).append((c, c - start))
    if not located:
        return {}
    pk = perm_key(key, seed)
    here = F.floor(pk / SLICE_WIDTH)
    # one test a row: a condition does not share work, and every mention of the key repeats its rounds
    ranked = df.where(here.isin(sorted({sl for _, sl in located}))).select(
        strata.alias("s"), here.alias("slice"), pk.alias("pk"), F.col(key).alias("id")
    )
    ranked = ranked.withColumn(
        "rn", F.row_number().over(Window.partitionBy("s", "slice").orderBy("pk", "id")) - 1
    )
    hits = F.lit(False)
    for (s, sl), places in located.items():
        hits = hits | (
            (F.col("s") == F.lit(s))
            & (F.col("slice") == F.lit(sl))
            & F.col("rn").isin([p for _, p in places])
        )
    out = {}
    for r in ranked.where(hits).collect():
        for c, place in located[r.s, r.slice]:
            if place == r.rn:
                out[r.s, c] = (r.pk, r.id)
    return out


def before(cut: tuple[int, int] | None, key: str, seed: int, pk: Column | None = None) -> Column:
    """True for rows ordered before the cut row; a cut past the end takes everything.

    ``pk`` is a column that holds the permutation key already.
    """
    if cut is None:
        return F.lit(True)
    pk = perm_key(key, seed) if pk is None else pk
    return (pk < F.lit(cut[0])) | ((pk == F.lit(cut[0])) & (F.col(key) < F.lit(cut[1])))


def assign_parts(
    df: DataFrame,
    sizes: dict[object, Sequence[tuple[str, int]]],
    target: str = "Class",
    key: str = "txn_id",
    seed: int = 42,
    out: str = "split",
    cast: str = "string",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Consecutive parts of exact size per stratum; the last part takes the rest.

    ``counted`` holds target and key of the same rows, where those are cheaper to read.
    """
    strata = F.col(target)
    cuts = {}
    for s, parts in sizes.items():
        ends, end = [], 0
        for _, n in parts[:-1]:
            end += n
            ends.append(end)
        cuts[s] = ends
    rows = cut_rows(df if counted is None else counted, strata, cuts, key, seed)
    label = F.lit(None).cast(cast)
    for s, parts in sizes.items():
        inner = F.lit(parts[-1][0]).cast(cast)
        for (name, _), c in reversed(list(zip(parts[:-1], cuts[s]))):
            mine = before(rows.get((s, c)), key, seed, F.col("_pk"))
            inner = F.when(mine, F.lit(name).cast(cast)).otherwise(inner)
        label = F.when(strata == F.lit(s), inner).otherwise(label)
    # the key as a column of its own is worked out once a row
    return df.withColumn("_pk", perm_key(key, seed)).withColumn(out, label).drop("_pk")


def part_sizes(n: int, fractions: Sequence[tuple[str, float]]) -> list[tuple[str, int]]:
    """Whole-number sizes: floor for all but the last part."""
    sizes = [(name, int(n * f + 1e-9)) for name, f in fractions[:-1]]
    return [*sizes, (fractions[-1][0], n - sum(s for _, s in sizes))]


def stratified_split(
    df: DataFrame, fractions: Sequence[tuple[str, float]], target: str = "Class",
    counted: DataFrame | None = None, **kw
) -> DataFrame:
    sizes = {k: part_sizes(n, fractions) for k, n in class_sizes(df if counted is None else counted, target).items()}
    return assign_parts(df, sizes, target, counted=counted, **kw)


def stratified_folds(df: DataFrame, k: int, target: str = "Class", out: str = "fold", **kw) -> DataFrame:
    """k folds with equal class shares: fold i holds ranks [i*n/k, (i+1)*n/k) of each class."""
    sizes = {}
    for c, n in class_sizes(df, target).items():
        edges = [i * n // k for i in range(k + 1)]
        sizes[c] = [(str(i), b - a) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return assign_parts(df, sizes, target, out=out, cast="int", **kw)


def sized_split(
    df: DataFrame, test: float = 0.2, val: float = 0.1, key: str = "txn_id", seed: int = 42
) -> DataFrame:
    """test = int(n * test), then val = int((n - test) * val), then the rest."""
    n = df.count()
    n_test = int(n * test)
    n_val = int((n - n_test) * val)
    tagged = df.withColumn("_all", F.lit(0))
    parts = {0: [("test", n_test), ("validation", n_val), ("train", n - n_test - n_val)]}
    return assign_parts(tagged, parts, "_all", key, seed).drop("_all")


def permutation_sample(df: DataFrame, n: int, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """n rows without replacement: the first n in permutation order, found by a cut row."""
    rows = cut_rows(df, F.lit(0), {0: [n]}, key, seed)
    return df.where(before(rows.get((0, n)), key, seed))


def shuffled(df: DataFrame, key: str = "txn_id", seed: int = 42) -> DataFrame:
    return df.withColumn("shuffle_key", perm_key(key, seed)).orderBy("shuffle_key", key)


def undersample(df: DataFrame, target: str = "Class", key: str = "txn_id", seed: int = 42) -> DataFrame:
    """All positives and as many negatives."""
    sizes = class_sizes(df, target)
    n = sizes.get(1, 0)
    rows = cut_rows(df, F.col(target), {0: [n]}, key, seed)
    return df.where((F.col(target) == 1) | before(rows.get((0, n)), key, seed))


def repeat_counts(n: int, want: int) -> tuple[int, int]:
    """Every row is repeated ``base`` times and the first ``extra`` ranks once more."""
    return want // n, want % n


def oversample(df: DataFrame, target: str = "Class", key: str = "txn_id", seed: int = 42) -> DataFrame:
    """Positives drawn with replacement until both classes have the same size.

    Draw k takes the positive whose class rank is ``draw_key(k) % n1``. The ranks of
    all positives are computed per slice, and draws are joined to them on the rank.
    """
    sizes = class_sizes(df, target)
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    pos = class_ranks(df.where(F.col(target) == 1), key, seed)
    draws = (
        df.sparkSession.range(n0)
        .select(F.col("id").alias("copy"), (perm_key("id", seed + 1) % F.lit(max(n1, 1))).alias("rank"))
    )
    drawn = draws.join(pos, "rank").drop("rank")
    neg = df.where(F.col(target) == 0).withColumn("copy", F.lit(0).cast("bigint"))
    return neg.unionByName(drawn.select(*neg.columns))


def class_ranks(df: DataFrame, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """0-based global rank in permutation order: rank within the slice plus the slice offset."""
    sl = F.floor(perm_key(key, seed) / SLICE_WIDTH)
    counts = slice_counts(df, F.lit(0), key, seed)
    offsets = counts.select(
        F.col("slice").alias("_slice"),
        F.coalesce(
            F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    inner = Window.partitionBy("_slice").orderBy(perm_key(key, seed), key)
    return (
        df.withColumn("_slice", sl)
        .withColumn("_rn", F.row_number().over(inner) - 1)
        .join(F.broadcast(offsets), "_slice")  # at most SLICES rows
        .withColumn("rank", F.col("_rn") + F.col("_offset"))
        .drop("_slice", "_rn", "_offset")
    )


def bootstrap_weights(df: DataFrame, seed: int, out: str = "weight", key: str = "txn_id") -> DataFrame:
    """Poisson(1) row weights: the large-n form of drawing n rows with replacement.

    The draw comes from the row's key, so it does not depend on partitions. The inverse
    of the distribution goes on until it reaches one in double precision.
    """
    import math

    steps, reached, chance = [], 0.0, math.exp(-1.0)
    while reached + chance > reached:
        reached += chance
        steps.append(reached)
        chance /= len(steps)
    w = F.lit(float(len(steps)))
    for k, edge in reversed(list(enumerate(steps))):
        w = F.when(F.col("_u") < F.lit(edge), F.lit(float(k))).otherwise(w)
    return df.withColumn("_u", unit_draw(key, seed)).withColumn(out, w).drop("_u")


def class_weights(sizes: dict[int, int], target: str = "Class") -> Column:
    """n / (classes * n_class) by the class of a row."""
    n, k = sum(sizes.values()), len(sizes)
    w = F.lit(1.0)
    for c, m in sizes.items():
        w = F.when(F.col(target) == F.lit(c), F.lit(n / (k * m))).otherwise(w)
    return w


def balanced_weights(df: DataFrame, target: str = "Class", out: str = "weight") -> DataFrame:
    """n / (classes * n_class), the usual balanced class weight."""
    return df.withColumn(out, class_weights(class_sizes(df, target), target))
