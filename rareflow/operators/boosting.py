"""Boosted trees by second-order histograms: gradient and Hessian sums grouped by (node, feature, bin).

Columns become quantile bins once, from one mergeable sketch a column. A tree grows in passes; each pass groups the rows of
the open nodes by node, feature and bin, with partial sums before the shuffle, and the
driver reads one row for each of these groups, a number that does not depend on the rows. Tasks add up Arrow batches with
numpy, so no row is made of every bin, and walk the trees whose margins are not written yet.
Best splits come first, until the tree has its leaves. A row finds its leaf by walking
the tree, whose nodes are two literal arrays, level by level.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.shape import edge_codes
from rareflow.session import stored

# executors may lack this library: what tasks call travels with them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: After so many trees the margins are written, so that plans stay short.
TREES_A_TABLE = 10
ROWS = "label int, held boolean, codes binary, margin double"


@dataclass(frozen=True)
class Settings:
    """``positive_weight`` multiplies the rows of class one; ``patience`` trees without a better validation loss end the fit."""

    rounds: int = 100
    depth: int = 5
    leaves: int = 16
    rate: float = 0.1
    bins: int = 64
    ridge: float = 1.0
    least_gain: float = 0.0
    least_hessian: float = 1.0
    positive_weight: float = 1.0
    patience: int = 10


@dataclass
class Tree:
    """A complete binary tree as arrays: node i has children 2i+1 and 2i+2; feature -1 marks a leaf.

    A row goes right if its bin of the feature is above the cut.
    """

    depth: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(depth, np.full(size, -1), np.zeros(size, int), np.zeros(size))

    def node(self, codes: Column) -> Column:
        """The number of the node where a row with these bins ends."""
        feature = F.array(*[F.lit(int(f)) for f in self.feature])
        cut = F.array(*[F.lit(int(c)) for c in self.cut])

        def step(at: Column, _: Column) -> Column:
            f = F.get(feature, at)
            right = (F.get(codes, f) > F.get(cut, at)).cast("int")
            return F.when(f < 0, at).otherwise(2 * at + 1 + right)

        # a fold over the levels: nesting one level in the next would repeat it again and again
        return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, self.depth))), F.lit(0), step)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """As ``node``, for an array with one line of bins a row."""
        at, row = np.zeros(len(codes), int), np.arange(len(codes))
        for _ in range(self.depth):
            f = self.feature[at]
            at = np.where(f < 0, at, 2 * at + 1 + (codes[row, f] > self.cut[at]))
        return at

    def margin(self, codes: Column) -> Column:
        return F.get(F.array(*[F.lit(float(v)) for v in self.value]), self.node(codes))


@dataclass
class Boosted:
    """Bin edges by column, the margin every row starts from, the trees, and the losses after each tree."""

    cols: list[str]
    edges: dict[str, list[float]]
    start: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[tuple[float, float | None]] = field(default_factory=list)

    def codes(self, df: DataFrame, out: str = "codes") -> DataFrame:
        """Adds the bins as one array; a null has bin 0, below all values."""
        coded = edge_codes(df, self.edges)
        bins = F.array(*[F.when(F.col(c).isNull(), 0).otherwise(F.col(f"_code_{c}") + 1) for c in self.cols])
        return coded.select(*df.columns, bins.alias(out))

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        rows = self.codes(df, "_codes")
        margin = F.lit(self.start)
        for i, tree in enumerate(self.trees):
            margin = margin + tree.margin(F.col("_codes"))
            if (i + 1) % TREES_A_TABLE == 0:  # a column of its own keeps the expression short
                rows, margin = rows.withColumn("_margin", margin), F.col("_margin")
        return rows.withColumn(out, 1.0 / (1.0 + F.exp(-margin))).select(*df.columns, out)

    def importances(self) -> list[tuple[str, int]]:
        """How many splits each column has, most first."""
        counts = dict.fromkeys(self.cols, 0)
        for tree in self.trees:
            for f in tree.feature[tree.feature >= 0]:
                counts[self.cols[int(f)]] += 1
        return sorted(counts.items(), key=lambda x: (-x[1], x[0]))


def best_splits(
    node: np.ndarray, feature: np.ndarray, bin_: np.ndarray, g: np.ndarray, h: np.ndarray, s: Settings
) -> dict[int, tuple[float, int, int, float, float, float, float]]:
    """node -> (gain, feature, cut, sums of g and h on the left, and in all) from the groups of one pass.

    Of equal gains the lower feature, then the lower cut wins. Nodes without a gain are left out.
    """
    out = {}
    for n in np.unique(node):
        best = None
        mine = node == n
        for f in np.unique(feature[mine]):
            rows = np.flatnonzero(mine & (feature == f))
            rows = rows[np.argsort(bin_[rows])]
            gs, hs = np.cumsum(g[rows]), np.cumsum(h[rows])
            total_g, total_h = gs[-1], hs[-1]
            left_g, left_h = gs[:-1], hs[:-1]
            right_g, right_h = total_g - left_g, total_h - left_h
            gain = left_g**2 / (left_h + s.ridge) + right_g**2 / (right_h + s.ridge) - total_g**2 / (total_h + s.ridge)
            gain = np.where((left_h >= s.least_hessian) & (right_h >= s.least_hessian), gain, -np.inf)
            if len(gain) and (i := int(np.argmax(gain))) >= 0 and gain[i] > s.least_gain and (best is None or gain[i] > best[0] + 1e-12):
                best = (float(gain[i]), int(f), int(bin_[rows[i]]), float(left_g[i]), float(left_h[i]), float(total_g), float(total_h))
        if best:
            out[int(n)] = best
    return out


def _bin_type(s: Settings):
    """The smallest whole number for the bins, one for null below and one for NaN above."""
    return np.uint8 if s.bins + 2 <= 256 else np.int32


def _codes(batch, s: Settings) -> np.ndarray:
    """The bins of a batch, one line a row."""
    col = batch.column("codes")
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(_bin_type(s)).reshape(len(col), -1)


def _packed(rows: DataFrame, s: Settings) -> DataFrame:
    """(label, held, codes, margin) with the bins of a row as one string of bytes, evenly spread."""

    def pack(batches):
        for batch in batches:
            bins = batch.column("codes").flatten().to_numpy(zero_copy_only=False).astype(_bin_type(s))
            lines = [line.tobytes() for line in bins.reshape(batch.num_rows, -1)] if batch.num_rows else []
            yield batch.set_column(2, "codes", pa.array(lines, pa.binary()))

    packed = rows.select("label", "held", "codes", "margin").mapInArrow(pack, ROWS)
    return stored(packed.repartition(rows.sparkSession.sparkContext.defaultParallelism), "boosted-rows")


def _with_margins(rows: DataFrame, s: Settings, pending: Sequence[Tree]) -> DataFrame:
    """The packed rows with the pending trees in their written margins."""

    def add(batches):
        for batch in batches:
            if batch.num_rows:
                margin = _margins(batch.column("margin").to_numpy(zero_copy_only=False), _codes(batch, s), pending)
                yield batch.set_column(3, "margin", pa.array(margin))

    return stored(rows.mapInArrow(add, ROWS), "boosted-rows")


def _margins(written: np.ndarray, codes: np.ndarray, pending: Sequence[Tree]) -> np.ndarray:
    """The written margins and what the trees since then add."""
    for tree in pending:
        written = written + tree.value[tree.places(codes)]
    return written


def _slopes(label: np.ndarray, margin: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(gradient, Hessian) of the logistic loss."""
    p = 1.0 / (1.0 + np.exp(-margin))
    weight = np.where(label == 1, s.positive_weight, 1.0)
    return weight * (p - label), weight * p * (1.0 - p)


def _losses(rows: DataFrame, s: Settings, pending: Sequence[Tree]) -> dict[bool, float]:
    """Mean logistic loss of the training and of the held rows."""

    def sums(batches):
        total, n = np.zeros(2), np.zeros(2, np.int64)
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(int)
            margin = _margins(batch.column("margin").to_numpy(zero_copy_only=False), _codes(batch, s), pending)
            sign = np.where(label == 1, -margin, margin)
            loss = np.where(label == 1, s.positive_weight, 1.0) * np.log1p(np.exp(np.minimum(sign, 500.0)))
            total += np.bincount(held, loss, 2)
            n += np.bincount(held, minlength=2)
        yield pa.RecordBatch.from_arrays([pa.array([False, True]), pa.array(total), pa.array(n)], ["held", "loss", "n"])

    parts = rows.mapInArrow(sums, "held boolean, loss double, n bigint").groupBy("held").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n"))
    return {r["held"]: r["loss"] / r["n"] for r in parts.collect() if r["n"]}


def _groups(rows: DataFrame, tree: Tree, open_: Sequence[int], s: Settings, pending: Sequence[Tree]) -> DataFrame:
    """Sums of gradient and Hessian by open node, feature and bin; each task adds up its own rows first."""
    width = s.bins + 2  # a bin for null below and one for NaN above

    def sums(batches):
        slot = np.full(len(tree.feature), -1)
        slot[open_] = np.arange(len(open_))
        total = None
        for batch in batches:
            codes = _codes(batch, s)
            at = slot[tree.places(codes)]
            inside = at >= 0
            if not inside.any():
                continue
            codes, at = codes[inside], at[inside]
            label, margin = (batch.column(c).to_numpy(zero_copy_only=False)[inside] for c in ("label", "margin"))
            g, h = _slopes(label, _margins(margin, codes, pending), s)
            if total is None:
                total = np.zeros((3, codes.shape[1], len(open_) * width))
            first = at * width
            for f in range(codes.shape[1]):
                cell = first + codes[:, f]
                for k, w in enumerate((g, h, None)):
                    total[k, f] += np.bincount(cell, w, len(open_) * width)
        if total is not None:
            f, cell = np.nonzero(total[2])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.asarray(open_)[cell // width].astype(np.int32)), pa.array(f.astype(np.int32)),
                    pa.array((cell % width).astype(np.int32)), pa.array(total[0][f, cell]), pa.array(total[1][f, cell]),
                ],
                ["node", "feature", "bin", "g", "h"],
            )

    parts = rows.select("codes", "label", "margin").mapInArrow(sums, "node int, feature int, bin int, g double, h double")
    return parts.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def grow(rows: DataFrame, s: Settings, pending: Sequence[Tree] = ()) -> Tree:
    """One tree on packed training rows (codes, label, margin); the margin lacks the ``pending`` trees."""
    tree = Tree.empty(s.depth)
    open_, leaves = [0], 1
    for _ in range(s.depth):
        found = _groups(rows, tree, open_, s, pending).toPandas()
        found = found.sort_values(["node", "feature", "bin"])
        splits = best_splits(*(found[c].to_numpy() for c in ("node", "feature", "bin", "g", "h")), s)
        open_ = []
        for n, (_, f, cut, left_g, left_h, all_g, all_h) in sorted(splits.items(), key=lambda x: (-x[1][0], x[0])):
            if leaves >= s.leaves:
                break
            leaves += 1
            tree.feature[n], tree.cut[n] = f, cut
            for child, cg, ch in ((2 * n + 1, left_g, left_h), (2 * n + 2, all_g - left_g, all_h - left_h)):
                tree.value[child] = -s.rate * cg / (ch + s.ridge)
                open_.append(child)
        if not open_ or leaves >= s.leaves:
            break
    return tree


def fit_boosted(
    train: DataFrame, cols: Sequence[str], settings: Settings | None = None, validation: DataFrame | None = None,
    target: str = "Class",
) -> Boosted:
    """Trees on ``train``; with ``validation`` the fit ends early and keeps the trees of the least loss.

    Rows with a null target are left out, NaN counts as the highest bin, and training
    rows of one class alone, or none, give a model without trees.
    """
    s = settings or Settings()
    cols = list(cols)
    known = train.where(F.col(target).isNotNull())
    counts = {r[target]: r["count"] for r in known.groupBy(target).count().collect()}
    n1, n0 = counts.get(1, 0) * s.positive_weight, counts.get(0, 0)
    chance = (n1 + 0.5) / (n1 + n0 + 1.0)
    probs = F.array(*[F.lit(i / s.bins) for i in range(1, s.bins)])
    found = known.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), probs, F.lit(100 * s.bins)).alias(c) for c in cols]).first()
    edges = {c: sorted(set(found[c] or [])) for c in cols}
    model = Boosted(cols, edges, math.log(chance / (1 - chance)))
    if not n1 or not n0:
        return model
    parts = known.withColumn("held", F.lit(False)).select(target, *cols, "held")
    if validation is not None:
        parts = parts.unionByName(validation.where(F.col(target).isNotNull()).withColumn("held", F.lit(True)).select(target, *cols, "held"))
    rows = model.codes(parts).select(
        F.col(target).cast("int").alias("label"), "held", "codes", F.lit(model.start).alias("margin")
    )
    rows = _packed(rows, s)
    best = (math.inf, 0)
    pending: list[Tree] = []
    for _ in range(s.rounds):
        tree = grow(rows.where(~F.col("held")), s, pending)
        if not (tree.feature >= 0).any():
            break
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == TREES_A_TABLE:
            rows, pending = _with_margins(rows, s, pending), []
        if validation is not None:
            losses = _losses(rows, s, pending)
            model.losses.append((losses.get(False), losses.get(True)))
            now = losses.get(True)
            if now is not None:
                best = min(best, (now, len(model.trees)))
                if len(model.trees) - best[1] >= s.patience:
                    break
    if validation is not None and best[1]:
        model.trees = model.trees[: best[1]]
    return model
