"""Exact quantiles (linear interpolation) that stay distributed.

Small inputs use the built-in ``percentile``. Beyond a checked size, quantile
sketches only bracket the wanted ranks; counting passes, a batch of values at a time,
then shrink each bracket until few rows are strictly inside it. No task ever holds the column.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareflow.operators.ordering import SMALL_GROUP, prefix_sums, value_counts

# executors may lack this library: what tasks call travels with them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMALL_VALUES = 6_000_000
INSIDE_LIMIT = 50_000


def interpolate(lo: float, hi: float, frac: float) -> float:
    return lo if lo == hi else lo + (hi - lo) * frac


def exact_quantiles(
    df: DataFrame,
    exprs: Mapping[str, Column],
    probs: Sequence[float],
    small: int = SMALL_VALUES,
    inside_limit: int = INSIDE_LIMIT,
    accuracy: int = 10000,
) -> dict[str, list[float]]:
    """Quantiles of several column expressions; nulls and NaN are skipped, at every size."""
    names = {f"q{i}": c for i, c in enumerate(exprs)}
    cols = df.select(
        *[F.nullif(e.cast("double"), F.lit(float("nan"))).alias(f"q{i}") for i, e in enumerate(exprs.values())]
    )
    if df.count() * len(exprs) <= small:
        row = cols.agg(
            *[F.percentile(q, F.array(*[F.lit(float(p)) for p in probs])).alias(q) for q in names]
        ).first()
        return {c: list(row[q]) if row[q] is not None else [None] * len(probs) for q, c in names.items()}
    found = _selected(cols, list(names), list(probs), inside_limit, accuracy)
    return {c: found[q] for q, c in names.items()}


@dataclass
class _Slot:
    col: str
    ranks: tuple[int, int]
    frac: float
    lo: float
    hi: float
    below: int = 0
    at_lo: int = 0
    inside: int = 0
    at_hi: int = 0
    found: dict[int, float] = field(default_factory=dict)

    def place(self, rank: int) -> float | None:
        """The value at ``rank`` when it is one of the bracket ends."""
        if self.below <= rank < self.below + self.at_lo:
            return self.lo
        if rank >= self.below + self.at_lo + self.inside:
            return self.hi
        return None


def _regions(slots: list[_Slot]) -> tuple[list[str], dict[str, list[float]]]:
    """The columns by number, and where each column's regions start.

    Every bracket end opens a region that holds only the end itself.
    """
    edges: dict[str, set[float]] = {}
    for s in slots:
        for e in (s.lo, s.hi):
            edges.setdefault(s.col, set()).update((e, math.nextafter(e, math.inf)))
    return list(edges), {c: [-math.inf, *sorted(v), math.inf] for c, v in edges.items()}


def _values(batch, i: int) -> np.ndarray:
    """A column of an Arrow batch without its nulls and NaN."""
    v = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
    return v[~np.isnan(v)]


def _count_brackets(cols: DataFrame, slots: list[_Slot]) -> None:
    """Rows below, at and between the bracket ends, for all slots in one aggregate."""
    names, splits = _regions(slots)
    cuts = [np.array(splits[c][1:-1]) for c in names]

    def count(batches):
        totals = [np.zeros(len(c) + 1, np.int64) for c in cuts]
        for batch in batches:
            for i, c in enumerate(cuts):
                totals[i] += np.bincount(np.searchsorted(c, _values(batch, i), "right"), minlength=len(c) + 1)
        for i, total in enumerate(totals):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                ["col", "region", "n"],
            )

    parts = cols.select(*names).mapInArrow(count, "col int, region int, n bigint")
    n: dict[str, dict[int, int]] = {c: {} for c in names}
    for r in parts.groupBy("col", "region").agg(F.sum("n").alias("n")).collect():
        n[names[r["col"]]][r.region] = r.n
    for s in slots:
        at = n[s.col]
        lo, hi = splits[s.col].index(s.lo), splits[s.col].index(s.hi)
        s.below = sum(v for k, v in at.items() if k < lo)
        s.at_lo = at.get(lo, 0)
        s.inside = sum(v for k, v in at.items() if lo < k < hi)
        s.at_hi = at.get(hi, 0) if hi > lo else 0


def _selected(cols, names, probs, inside_limit, accuracy):
    acc = F.lit(accuracy)
    step = 2.0 / accuracy
    wide = 5.0 / accuracy  # beyond the rank error of a sketch with this k, 2.3 / k^0.97
    brackets = [max(0.0, p - wide) for p in probs] + [min(1.0, p + wide) for p in probs]
    ranks = F.array(*[F.lit(p) for p in brackets])

    def ends(c):
        sketch = F.kll_sketch_agg_double(c, F.lit(min(65535, max(8, accuracy))))
        return F.when(F.count(c) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))

    first = cols.agg(
        *[F.count(c).alias(f"{c}_n") for c in names],
        *[F.min(c).alias(f"{c}_min") for c in names],
        *[F.max(c).alias(f"{c}_max") for c in names],
        *[ends(c).alias(f"{c}_q") for c in names],
    ).first()
    slots: dict[tuple[str, int], _Slot] = {}
    for c in names:
        n = first[f"{c}_n"]
        for j, p in enumerate(probs):
            if not n:
                continue
            pos = p * (n - 1)
            q = first[f"{c}_q"]
            slots[c, j] = _Slot(
                c, (math.floor(pos), math.ceil(pos)), pos - math.floor(pos), q[j], q[len(probs) + j]
            )
    active = list(slots.values())
    checked = False
    while active:
        _count_brackets(cols, active)
        if not checked:
            missed = [
                s
                for s in active
                if s.ranks[0] < s.below
                or s.ranks[1] >= s.below + s.at_lo + s.inside + s.at_hi
            ]
            for s in missed:
                s.lo, s.hi = first[f"{s.col}_min"], first[f"{s.col}_max"]
            if missed:
                _count_brackets(cols, missed)
            checked = True
        for s in active:
            for r in s.ranks:
                v = s.place(r)
                if v is not None:
                    s.found[r] = v
        active = [s for s in active if len(s.found) < len(set(s.ranks))]
        ready = [s for s in active if s.inside <= inside_limit]
        if ready:
            _finish(cols, ready)
        active = [s for s in active if s.inside > inside_limit]
        if active:
            _narrow(cols, active, acc, step)
    out = {}
    for c in names:
        out[c] = []
        for j in range(len(probs)):
            s = slots.get((c, j))
            out[c].append(
                None if s is None else interpolate(s.found[s.ranks[0]], s.found[s.ranks[1]], s.frac)
            )
    return out


def _narrow(cols, slots, acc, step):
    """Approximate quantiles of what is strictly inside each bracket give a tighter one."""
    aggs = []
    for i, s in enumerate(slots):
        base = s.below + s.at_lo
        p0 = max(0.0, (s.ranks[0] - base) / s.inside - step)
        p1 = min(1.0, (s.ranks[1] - base + 1) / s.inside + step)
        c = F.col(s.col)
        aggs.append(
            F.percentile_approx(F.when((c > s.lo) & (c < s.hi), c), [p0, p1], acc).alias(f"q{i}")
        )
    row = cols.agg(*aggs).first()
    for i, s in enumerate(slots):
        base = s.below + s.at_lo
        q0, q1 = row[f"q{i}"]
        if s.ranks[0] >= base:
            s.lo = q0
        if s.ranks[1] < base + s.inside:
            s.hi = q1


def _finish(cols, slots):
    """Rank the few rows strictly inside each bracket; only the wanted ranks come back.

    Slots and ranks are rows of small tables: as conditions of one expression, some
    hundreds of them nest too deep for the driver.
    """
    spark = cols.sparkSession
    names = list(dict.fromkeys(s.col for s in slots))
    brackets = [(names.index(s.col), s.lo, s.hi) for s in slots]
    ranks = [(i, r, r - s.below - s.at_lo) for i, s in enumerate(slots) for r in sorted(set(s.ranks))]
    ranks = spark.createDataFrame(ranks, "slot int, rank bigint, place bigint")

    def held(batches):
        for batch in batches:
            values = [_values(batch, i) for i in range(len(names))]
            for slot, (i, lo, hi) in enumerate(brackets):
                v = values[i][(values[i] > lo) & (values[i] < hi)]
                if len(v):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), slot, np.int32)), pa.array(v)], ["slot", "value"])

    inside = cols.select(*names).mapInArrow(held, "slot int, value double")
    counts = inside.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = counts.withColumn("cum", F.sum("n").over(Window.partitionBy("slot").orderBy("value")))
    here = (F.col("cum") > F.col("place")) & (F.col("cum") - F.col("n") <= F.col("place"))
    for row in cum.join(F.broadcast(ranks), "slot").where(here).collect():
        slots[row.slot].found[row["rank"]] = row.value


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float],
    small: int = SMALL_GROUP,
) -> DataFrame:
    """Exact quantiles per group for any number of groups, hot groups included.

    Rows collapse to value counts, running counts find the wanted ranks, and
    only two rows per quantile are aggregated per group.
    """
    counts = value_counts(df, value, by).withColumn("cum", F.col("n"))
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("_size"))
    cum = prefix_sums(counts, value, {"cum": "cum"}, by, small=small).join(sizes, list(by))
    aggs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_size") - 1)
        for end, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("cum") > rank) & (F.col("cum") - F.col("n") <= rank)
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}_{end}"))
    ends = cum.groupBy(*by, "_size").agg(*aggs)
    frac = {n: F.lit(float(p)) * (F.col("_size") - 1) for n, p in probs.items()}
    return ends.select(
        *by,
        F.col("_size").alias("n"),
        *[
            (
                F.col(f"_{n}_lo")
                + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * (frac[n] - F.floor(frac[n]))
            ).alias(n)
            for n in probs
        ],
    )
