"""Training of Spark's multilayer perceptron with matrix products in Arrow batches.

Spark's estimator works out its gradients with plain JVM loops. Here the same blocks of
rows meet the same weights in NumPy: they are written once as matrices, each pass adds up the
gradient of every task, and the driver holds a few vectors as long as the weights. Start
weights, loss, steps and the end follow Spark's estimator, so the fitted model is the same
but for rounding, and is Spark's own class.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.session import stored

#: Rows of a written matrix, and of those that are worked on at a time.
MATRIX_ROWS, AT_ONCE = 4096, 512
#: Steps that shape the inverse Hessian; Wolfe conditions; steps of a line search, values that must agree at the end.
MEMORY, DECREASE, CURVATURE, TRIES, VALUES = 10, 1e-4, 0.9, 10, 20
Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]


class StepFailed(ValueError):
    """No step along this direction."""


def matrices(rows: DataFrame, features: str, label: str, classes: int, block: int) -> DataFrame:
    """(x, y, share, blocks): rows of each task as matrices in order, with the share of a row in its block.

    A task's rows make blocks of ``block``, the last one maybe smaller; each block's mean counts alike.
    """
    wide = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    most = max(1, MATRIX_ROWS // block) * block

    def packed(x: np.ndarray, y: np.ndarray, size: int) -> pa.RecordBatch:
        columns = [pa.array([x.tobytes()], pa.binary()), pa.array([y.astype(np.int8).tobytes()], pa.binary())]
        columns += [pa.array([1.0 / size]), pa.array([len(x) // size], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["x", "y", "share", "blocks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = None, np.zeros(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isin(found, np.arange(classes)).all():
                raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
            new = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x, y = new if x is None else np.concatenate([x, new]), np.concatenate([y, found])
            for at in range(0, len(x) - most + 1, most):
                yield packed(x[at : at + most], y[at : at + most], block)
            done = len(x) // most * most
            x, y = x[done:], y[done:]
        whole = len(y) // block * block
        if whole:
            yield packed(x[:whole], y[:whole], block)
        if len(y) > whole:
            yield packed(x[whole:], y[whole:], len(y) - whole)

    return wide.mapInArrow(run, "x binary, y binary, share double, blocks long")


def shaped(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, offsets) of each layer, as views of one vector."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, layers: Sequence[int], out: np.ndarray) -> float:
    """Adds the summed gradient of these rows' cross entropy to ``out``; returns their summed loss."""
    net, slopes = shaped(weights, layers), shaped(out, layers)
    outputs = [x]
    for i, (w, b) in enumerate(net):
        z = outputs[-1] @ w
        z += b
        if i < len(net) - 1:
            np.negative(z, out=z)
            with np.errstate(over="ignore"):
                np.exp(z, out=z)
            z += 1.0
            np.reciprocal(z, out=z)
        else:
            z -= z.max(axis=1, keepdims=True)
            np.exp(z, out=z)
            z /= z.sum(axis=1, keepdims=True)
        outputs.append(z)
    delta = outputs[-1]
    own = np.arange(len(y)), y
    with np.errstate(divide="ignore"):
        loss = -float(np.log(delta[own]).sum())
    delta[own] -= 1.0
    for i in range(len(net) - 1, -1, -1):
        w, b = slopes[i]
        w += outputs[i].T @ delta
        b += delta.sum(axis=0)
        if i:
            before = delta @ net[i][0].T
            before *= outputs[i]
            np.subtract(1.0, outputs[i], out=outputs[i])
            before *= outputs[i]
            delta = before
    return loss


def objective(table: DataFrame, layers: Sequence[int]) -> Objective:
    """Mean loss over blocks and its gradient: one pass over the matrices for each call."""
    blocks = table.agg(F.sum("blocks")).first()[0]
    # a task for each core and some more: the driver adds up one gradient a task
    rows = table.select("x", "y", "share").coalesce(3 * table.sparkSession.sparkContext.defaultParallelism)

    def value(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, loss = np.zeros(len(weights)), 0.0
            part = np.zeros(len(weights))
            for batch in batches:
                for i in range(batch.num_rows):
                    y = np.frombuffer(batch.column(1)[i].as_buffer(), np.int8)
                    x = np.frombuffer(batch.column(0)[i].as_buffer(), float).reshape(len(y), -1)
                    share = batch.column(2)[i].as_py()
                    part[:] = 0.0
                    for at in range(0, len(y), AT_ONCE):
                        loss += share * gradient(x[at : at + AT_ONCE], y[at : at + AT_ONCE], weights, layers, part)
                    total += share * part
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([total.tobytes()], pa.binary())], ["loss", "total"])

        found = rows.mapInArrow(run, "loss double, total binary").collect()
        slope = np.sum([np.frombuffer(r["total"], float) for r in found], axis=0)
        return sum(r["loss"] for r in found) / blocks, slope / blocks

    return value


def direction(slope: np.ndarray, steps: Sequence[np.ndarray], changes: Sequence[np.ndarray]) -> np.ndarray:
    """Downhill by the inverse Hessian of the last steps and changes of the slope, newest first."""
    scale = 1.0
    if steps:
        scale = float(steps[0] @ changes[0])
        if not scale >= 0:
            raise StepFailed("no curvature")
        scale /= float(changes[0] @ changes[0])
    down, shares = slope.copy(), []
    rho = [float(s @ c) for s, c in zip(steps, changes)]
    for s, c, r in zip(steps, changes, rho):
        shares.append(float(s @ down) / r)
        if math.isnan(shares[-1]):
            raise StepFailed("no curvature")
        down -= shares[-1] * c
    down *= scale
    for s, c, r, a in reversed(list(zip(steps, changes, rho, shares))):
        down += (a - float(c @ down) / r) * s
    return -down


def between(low: tuple, high: tuple) -> float:
    """The minimum of the cubic through two (place, value, slope), not too near either."""
    (a, fa, da), (b, fb, db) = sorted((low, high), key=lambda p: p[0])
    d1 = da + db - 3.0 * (fa - fb) / (a - b)
    root = d1 * d1 - da * db
    d2 = math.sqrt(root) if root >= 0 else math.nan
    below = db - da + 2.0 * d2
    t = b - (b - a) * (db + d2 - d1) / below if below else math.nan
    if t < a + 0.1 * (b - a):
        return a + 0.1 * (b - a)
    return a + 0.9 * (b - a) if t > a + 0.9 * (b - a) else t


def line_search(phi: Callable[[float], tuple], start: tuple, t: float) -> float:
    """A step that meets the strong Wolfe conditions; ``start`` is (0, value, slope) and ``t`` the first try."""
    _, value, slope = start
    if slope > 0:
        raise StepFailed("not downhill")

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(TRIES):
            c = phi(between(low, high))
            if c[1] > value + DECREASE * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= CURVATURE * abs(slope):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise StepFailed("no step between")

    low = start
    for i in range(TRIES):
        c = phi(t)
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + DECREASE * t * slope or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= CURVATURE * abs(slope):
            return c[0]
        if c[2] >= 0:
            return zoom(c, low)
        low = c
        t *= 1.5
    raise StepFailed("no step")


def minimized(f: Objective, x: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """Limited-memory BFGS; a step that fails is tried once more without memory."""
    known: list[tuple[np.ndarray, tuple[float, np.ndarray]]] = []

    def cached(point: np.ndarray) -> tuple[float, np.ndarray]:
        if not known or not np.array_equal(known[0][0], point):
            known[:] = [(point, f(point))]
        return known[0][1]

    value, slope = cached(x)
    first, values = value, [math.inf]
    steps: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    done, failed = 0, False
    while done < rounds:
        if len(values) >= 2 and abs(value - max(values)) <= tolerance * first:
            break
        if np.linalg.norm(slope) <= max(tolerance * value, 1e-8):
            break
        try:
            down = direction(slope, steps, changes)

            def phi(t: float) -> tuple:
                v, g = cached(x + t * down)  # noqa: B023
                return t, v, float(g @ down)  # noqa: B023

            t = line_search(phi, (0.0, value, float(slope @ down)), 1.0 / float(np.linalg.norm(down)) if done == 0 else 1.0)
            if t * np.linalg.norm(slope) < 1e-10:
                raise StepFailed("step too small")
        except StepFailed:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        failed = False
        new = x + t * down
        v, g = cached(new)
        steps, changes = [new - x, *steps][:MEMORY], [g - slope, *changes][:MEMORY]
        x, value, slope = new, v, g
        values = [*values, value][-VALUES:]
        done += 1
    return x


class Perceptron(MultilayerPerceptronClassifier):
    """Spark's estimator with another way to its weights."""

    #: Matrices go to Python few at a time.
    SETTING, FEW = "spark.sql.execution.arrow.maxRecordsPerBatch", "8"

    def _fit(self, dataset: DataFrame):
        if self.getSolver() != "l-bfgs":
            return super()._fit(dataset)
        conf, layers = dataset.sparkSession.conf, self.getLayers()
        two = dataset.sparkSession.createDataFrame(
            [(Vectors.dense([0.0] * layers[0]), float(y)) for y in range(layers[-1])],
            [self.getFeaturesCol(), self.getLabelCol()],
        )
        start = MultilayerPerceptronClassifier._fit(self.copy({self.maxIter: 0}), two).weights.toArray()
        table = stored(matrices(dataset, self.getFeaturesCol(), self.getLabelCol(), layers[-1], self.getBlockSize()), "net-matrices")
        before = conf.get(self.SETTING)
        conf.set(self.SETTING, self.FEW)
        try:
            found = minimized(objective(table, layers), start, self.getMaxIter(), self.getTol())
        finally:
            conf.set(self.SETTING, before)
        model = MultilayerPerceptronClassifier._fit(self.copy({self.maxIter: 0, self.initialWeights: Vectors.dense(found)}), two)
        model.set(model.maxIter, self.getMaxIter())
        if not self.isSet(self.initialWeights):
            model.clear(model.initialWeights)
        return model
