"""Sequential hyper-parameter search by tree-structured Parzen estimators, with early stops.

Finished trials are split into the better few and the rest. Each side is a density: for
every parameter a mixture of bells around its trials' values and an even part. The next
trial is the one, of several drawn from the better side's density, that this density
favours most over the other's. Trials run in batches of bounded size, and a trial that
after some folds is below the median of earlier ones at that point is stopped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.operators import evaluation as ev
from rareflow.operators import models as md
from rareflow.operators.sampling import class_weights, stratified_folds
from rareflow.session import stored

#: Share of trials that count as better, most of them, and draws for each proposal.
BETTER, MOST_BETTER, DRAWS = 0.25, 25, 24


@dataclass(frozen=True)
class Range:
    """Values from ``low`` to ``high``; whole numbers if both are, evenly on a log scale if asked."""

    low: float
    high: float
    log: bool = False

    @property
    def whole(self) -> bool:
        return isinstance(self.low, int) and isinstance(self.high, int)

    def value(self, unit: float) -> float | int:
        """The value at ``unit`` of the way, from 0 to 1."""
        low, high = (self.low - 0.5, self.high + 0.5) if self.whole else (self.low, self.high)
        if self.log:
            low, high = math.log(max(low, 1e-300)), math.log(high)
        x = low + min(max(unit, 0.0), 1.0) * (high - low)
        x = math.exp(x) if self.log else x
        return int(min(max(round(x), self.low), self.high)) if self.whole else float(min(max(x, self.low), self.high))


# Search ranges of the boosted trees.
BOOSTED = {
    "maxIter": Range(100, 500),
    "maxDepth": Range(3, 10),
    "stepSize": Range(0.01, 0.3, log=True),
    "subsamplingRate": Range(0.6, 1.0),
}


@dataclass
class Trial:
    """A point in the unit cube, its mean metric after each fold, and whether it was stopped early."""

    number: int
    unit: np.ndarray
    steps: list[float] = field(default_factory=list)
    stopped: bool = False

    @property
    def metric(self) -> float:
        return self.steps[-1] if self.steps else -math.inf


def bell_widths(centres: np.ndarray) -> np.ndarray:
    """Each bell reaches to the farther of its neighbours or the border, within bounds."""
    order = np.argsort(centres, kind="stable")
    edged = np.concatenate(([0.0], centres[order], [1.0]))
    gaps = np.maximum(edged[1:-1] - edged[:-2], edged[2:] - edged[1:-1])
    out = np.empty(len(centres))
    out[order] = np.clip(gaps, 1.0 / min(100, len(centres) + 1) / 2, 1.0)
    return out


def _mass(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    erf = np.vectorize(math.erf, otypes=[float])
    return np.maximum(0.5 * (erf(b / math.sqrt(2)) - erf(a / math.sqrt(2))), 1e-12)


def log_density(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Log of the mixture of bells cut to [0, 1] and one even part."""
    if not len(centres):
        return np.zeros(len(x))
    w = bell_widths(centres)
    z = (x[:, None] - centres) / w
    bells = np.exp(-0.5 * z * z) / (w * math.sqrt(2 * math.pi)) / _mass(-centres / w, (1 - centres) / w)
    return np.log((bells.sum(axis=1) + 1.0) / (len(centres) + 1))


def draw(centres: np.ndarray, rng: np.random.Generator, n: int) -> np.ndarray:
    """Values from the mixture: a bell or the even part by lot, bells drawn again outside [0, 1]."""
    out = rng.random(n)
    if not len(centres):
        return out
    w = bell_widths(centres)
    which = rng.integers(0, len(centres) + 1, n)
    for i in np.flatnonzero(which < len(centres)):
        for _ in range(100):
            x = rng.normal(centres[which[i]], w[which[i]])
            if 0 <= x <= 1:
                out[i] = x
                break
    return out


def propose(done: Sequence[tuple[np.ndarray, float]], size: int, rng: np.random.Generator) -> np.ndarray:
    """The next point from finished (point, metric) trials; higher metrics are better."""
    if not done:
        return rng.random(size)
    points, metrics = np.array([p for p, _ in done]), np.array([m for _, m in done])
    order = np.argsort(-metrics, kind="stable")
    few = min(MOST_BETTER, max(1, math.ceil(BETTER * math.sqrt(len(done)) * 2)))
    better, rest = points[order[:few]], points[order[few:]]
    tried = np.column_stack([draw(better[:, j], rng, DRAWS) for j in range(size)])
    gain = sum(log_density(tried[:, j], better[:, j]) - log_density(tried[:, j], rest[:, j]) for j in range(size))
    return tried[int(np.argmax(gain))]


def should_stop(trial: Trial, others: Sequence[Trial]) -> bool:
    """Whether the trial's mean so far is below the median of what the others had after as many folds."""
    at = len(trial.steps)
    known = sorted(t.steps[at - 1] for t in others if len(t.steps) >= at)
    if len(known) < 4:
        return False
    return trial.metric < (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2


def parzen_search(
    train: DataFrame, cols: Sequence[str], make: Callable[[dict], Estimator], ranges: Mapping[str, Range],
    trials: int = 100, startup: int = 10, batch: int = 4, folds: int = 3, metric: str = "average_precision",
    target: str = "Class", key: str = "txn_id", seed: int = 42,
) -> tuple[dict, DataFrame]:
    """(best parameters, one row per trial): the parameters with the best mean metric over stratified folds.

    Class weights come from each fold's own training part. ``batch`` trials are fitted at
    a time, fold by fold; within a batch none knows the others' results, so that reruns agree.
    Vectors are made once, and a fold's held rows are read once for all models of a batch.
    """
    names = list(ranges)
    folded = md.labelled(stratified_folds(train.select(key, target, *cols), folds, target, key=key), target)
    rows = stored(md.assembler(cols).transform(folded).select(target, "label", "fold", "features"), "search-folds")
    rows = rows.persist()  # each fit reads them twice
    counts = rows.groupBy("fold", target).count().collect()  # one row for each fold and class
    rng = np.random.default_rng(seed)
    done: list[Trial] = []
    measure = ev.average_precision if metric == "average_precision" else ev.roc_auc

    def values(unit: np.ndarray) -> dict:
        return {n: ranges[n].value(float(u)) for n, u in zip(names, unit)}

    def inside(k: int) -> DataFrame:
        sizes: dict[int, int] = {}
        for r in counts:
            if r["fold"] != k:
                sizes[r[target]] = sizes.get(r[target], 0) + r["count"]
        return rows.where(F.col("fold") != k).withColumn("weight", class_weights(sizes, target))

    def fitted(trial: Trial, k: int) -> PipelineModel:
        made = make(values(trial.unit))
        return Pipeline(stages=list(made) if isinstance(made, (list, tuple)) else [made]).fit(inside(k))

    def side_by_side(pool: ThreadPoolExecutor, run: Callable, items: Sequence) -> list:
        # a thread target for each call: a thread must not share one with another
        waiting = [pool.submit(inheritable_thread_target(train.sparkSession)(run), x) for x in items]
        return [w.result() for w in waiting]

    def metrics(models: Sequence[PipelineModel], k: int) -> list[float]:
        """All models score the held rows in one pass, and one ranking has the scores of all."""
        held = rows.where(F.col("fold") == k).select(F.col("label").cast("int").alias("label"), "features")
        scored = md.member_scores(held, {str(i): m for i, m in enumerate(models)})
        each = [F.struct(F.lit(i).alias("candidate"), F.col(f"score_{i}").alias("score")) for i in range(len(models))]
        long = scored.select("label", F.inline(F.array(*each))).persist()
        long.count()
        found = {r["candidate"]: r[1] for r in measure(long, ["candidate"]).collect()}  # one row a model
        long.unpersist()
        return [float(found.get(i) or 0.0) for i in range(len(models))]

    with ThreadPoolExecutor(batch) as pool:
        while len(done) < trials:
            before = list(done)
            finished = [(t.unit, t.metric) for t in before if not t.stopped] or [(t.unit, t.metric) for t in before]
            size = min(batch, trials - len(done))
            units = [rng.random(len(names)) if len(done) < startup else propose(finished, len(names), rng) for _ in range(size)]
            waiting = [Trial(len(done) + i, u) for i, u in enumerate(units)]
            done += waiting
            found: dict[int, list[float]] = {t.number: [] for t in waiting}
            for k in range(folds):
                models = side_by_side(pool, lambda t: fitted(t, k), waiting)  # noqa: B023
                for t, m in zip(waiting, metrics(models, k)):
                    found[t.number].append(m)
                    t.steps.append(sum(found[t.number]) / (k + 1))
                    t.stopped = k + 1 < folds and should_stop(t, before)
                waiting = [t for t in waiting if not t.stopped]
                if not waiting:
                    break
    rows.unpersist()
    best = max((t for t in done if not t.stopped), key=lambda t: (t.metric, -t.number))
    table = [
        (t.number, *(float(v) for v in values(t.unit).values()), len(t.steps), t.stopped, float(t.metric), t is best) for t in done
    ]
    kinds = ", ".join(f"`{n}` double" for n in names)
    out = train.sparkSession.createDataFrame(table, f"trial int, {kinds}, folds int, stopped boolean, metric double, is_best boolean")
    return values(best.unit), out
