"""Quality classifier: naive Bayes support vectors.

A text is the set of its n-grams: single words, and runs of one to three word shapes. A
shape keeps a word's punctuation and letter case but not its letters, and tells whether
the word repeats the one before or one of the line's earlier ones; line ends tell
whether the line repeats an earlier one. Each n-gram's indicator is scaled by the log
ratio of its smoothed class frequencies, and a linear hinge-loss model over the scaled
indicators is fitted by dual coordinate descent. A logistic curve, fitted on rows that
the model has not seen, turns margins into scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import held_out, whole

#: Labelled rows that the model is fitted on; of larger tables a hash picks so many on average.
TRAIN_ROWS = 6000
#: Parameters of the fit: n-grams that fewer texts of the sample have are left out, and no
#: more than the most frequent ``MOST_GRAMS`` get a weight. Scores read every n-gram of a text.
LEAST_TEXTS, MOST_GRAMS = 5, 60_000
SEED = 8
PENALTY, EPOCHS = 0.3, 30
#: The share of the sample that the curve from margins to scores is fitted on.
CURVE_SHARE = 0.25
#: Words are read in pieces of this many, so that any length fits.
CHUNK_WORDS = 50_000
MEMO = 400_000

_CLASSES = re.compile(r"[A-ZÀ-ÖØ-Þ]+|[^\W\d_A-ZÀ-ÖØ-Þ]+|\d+|([^\w])\1*", re.UNICODE)


def word_shape(word: str) -> str:
    """Runs of capitals as A, other letters as a, digits as 0, other signs as one of themselves."""

    def short(m: re.Match) -> str:
        if m.group(1):
            return m.group(1) if len(m.group(0)) == 1 else m.group(1) * 2
        c = m.group(0)[0]
        return "0" if c.isdigit() else "A" if c.isupper() else "a"

    if word.islower() and word[:-1].isalpha():
        return "a" if word[-1].isalpha() else "a" + ("0" if word[-1].isdigit() else word[-1])
    return _CLASSES.sub(short, word)


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


class Grams:
    """Distinct n-gram hashes of texts; numbers, shapes and hashes of words met before are kept."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.shapes, self.names = np.zeros(2 * MEMO, np.uint64), np.zeros(2 * MEMO, np.int64)

    def _number(self, words: list[str]) -> np.ndarray:
        known = self.known
        for w in set(words).difference(known):
            n = known[w] = len(known)
            if n >= len(self.names):
                self.names, self.shapes = np.resize(self.names, 2 * n), np.resize(self.shapes, 2 * n)
            self.names[n] = _hash("w " + w.lower())
            self.shapes[n] = _hash("s " + word_shape(w)) & 0xFFFFFFFC
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def of(self, text: str) -> np.ndarray:
        """Sorted hashes; a text without a word has the one that says so."""
        if len(self.known) > MEMO:
            self._forget()
        lines = [(line, line.split()) for line in text.split("\n")]
        lines = [x for x in lines if x[1]]
        if not lines:
            return np.array([_hash("empty")], np.int64)
        found, seen, held, held_words = [], set(), [], 0
        before = np.zeros(0, np.uint64)  # the last marks of the piece before, for runs over its edge
        for line, words in lines:
            held.append((words, line in seen))
            seen.add(line)
            held_words += len(words)
            if held_words > CHUNK_WORDS:
                some, before = self._grams(held, before)
                found += some
                held, held_words = [], 0
        if held:
            found += self._grams(held, before)[0]
        return np.unique(np.concatenate(found))

    def _grams(self, lines: list[tuple[list[str], bool]], before: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        ids = self._number([w for words, _ in lines for w in words])
        sizes = np.array([len(words) for words, _ in lines])
        line = np.repeat(np.arange(len(lines)), sizes)
        later = np.ones(len(ids), np.uint64)
        later[np.unique(line * (len(self.known) + 1) + ids, return_index=True)[1]] = 0
        later[1:][(ids[1:] == ids[:-1]) & (line[1:] == line[:-1])] = 2
        ends = np.array([7 if again else 3 for _, again in lines], np.uint64)
        marks = np.insert(self.shapes[ids] + later, np.cumsum(sizes), ends)
        marks = np.concatenate([before, marks])
        return [self.names[np.unique(ids)], *_runs(marks)], marks[-2:]


def _runs(marks: np.ndarray) -> list[np.ndarray]:
    """Distinct hashes of one, two and three marks in a row."""
    mixed = [marks]
    for n in (1, 2):
        if len(marks) > n:
            mixed.append(mixed[-1][:-1] * np.uint64(0x85EBCA77) + marks[n:])
    spread = np.uint64(0x9E3779B97F4A7C15)
    return [((np.unique(x) * spread + np.uint64(n)) >> np.uint64(20)).astype(np.int64) for n, x in enumerate(mixed)]


def gram_rows(rows: DataFrame) -> DataFrame:
    """(label, grams) of the (label, text) rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = Grams()
        for frame in frames:
            yield pd.DataFrame({"label": frame["label"], "grams": [grams.of(t).tolist() for t in frame["text"]]})

    return rows.select("label", "text").mapInPandas(run, "label int, grams array<long>")


def dual_coordinate_descent(
    rows: list[np.ndarray], values: np.ndarray, signs: np.ndarray, penalty: float = PENALTY, epochs: int = EPOCHS
) -> np.ndarray:
    """Weights of the L2-regularised hinge-loss model over rows of set columns.

    Row i has value ``values[j]`` at each column j it lists, and a constant 1 at the last
    column. The dual variable of one row at a time is set to its best value in
    [0, cap], rows in a fresh random order each epoch. Rows of the rarer class have a
    cap as much higher as they are rarer.
    """
    rng = np.random.default_rng(SEED)
    weights, duals = np.zeros(len(values) + 1), np.zeros(len(rows))
    norms = np.array([np.square(values[r]).sum() + 1 for r in rows])
    share = {s: max(1, (signs == s).sum()) / max(1, len(signs)) for s in (-1, 1)}
    caps = np.array([penalty * min(10.0, 0.5 / share[s]) for s in signs])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            slope = signs[i] * (weights[r] @ values[r] + weights[-1]) - 1
            now = min(max(duals[i] - slope / norms[i], 0.0), caps[i])
            step = now - duals[i]
            if step:
                weights[r] += step * signs[i] * values[r]
                weights[-1] += step * signs[i]
                duals[i] = now
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the curve from margins to the chance of label 1, by Newton steps."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - goal) + 1e-3 * beta)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


@dataclass
class Model:
    """Weights by n-gram hash, the constant, and the curve from margins to scores."""

    grams: np.ndarray
    weights: np.ndarray
    constant: float
    slope: float
    offset: float

    def margin(self, grams: np.ndarray) -> float:
        if not len(self.grams):
            return self.constant
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return float(self.weights[at[self.grams[at] == grams]].sum() + self.constant)

    def score(self, grams: np.ndarray) -> float:
        z = self.slope * self.margin(grams) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(found: list[tuple[int, np.ndarray]]) -> Model:
    """The model of (label, distinct sorted n-grams) rows.

    With one class alone, or no rows, every score is that class's smoothed share.
    """
    y = np.array([label for label, _ in found], dtype=int)
    if len(set(y)) < 2:
        chance = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, 1.0, float(np.log(chance / (1 - chance))))
    names, counts = np.unique(np.concatenate([g for _, g in found]), return_counts=True)
    order = np.argsort(-counts, kind="stable")[:MOST_GRAMS]
    names = np.sort(names[order[counts[order] >= min(LEAST_TEXTS, max(1, len(y) // 20))]])
    rows = []
    for _, g in found:
        at = np.minimum(np.searchsorted(names, g), max(0, len(names) - 1))
        rows.append(at[names[at] == g] if len(names) else at[:0])
    draw = np.random.default_rng(SEED).random(len(y))
    curve = draw < CURVE_SHARE
    if len(set(y[curve])) < 2 or len(set(y[~curve])) < 2:
        curve[:] = False

    def learn(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with_1, with_0 = np.ones(len(names)), np.ones(len(names))
        for i in np.flatnonzero(chosen):
            (with_1 if y[i] else with_0)[rows[i]] += 1
        ratios = np.log(with_1 / with_1.sum()) - np.log(with_0 / with_0.sum())
        signs = np.where(y[chosen] == 1, 1, -1)
        return ratios, dual_coordinate_descent([rows[i] for i in np.flatnonzero(chosen)], ratios, signs)

    def margins(ratios: np.ndarray, weights: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        return np.array([weights[rows[i]] @ ratios[rows[i]] + weights[-1] for i in np.flatnonzero(chosen)])

    ratios, weights = learn(~curve)
    unseen = curve if curve.any() else np.ones(len(y), bool)
    slope, offset = logistic_curve(margins(ratios, weights, unseen), y[unseen])
    return Model(names, weights[:-1] * ratios, float(weights[-1]), slope, offset)


def sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, fold: int, id_col: str, text_col: str, train_rows: int) -> DataFrame:
    """(label, text) of labelled rows outside the held-out fold, ``train_rows`` on average.

    Labels with a null id or value teach nothing, nor do ids without a document. The
    picked labels are few, so Spark sends them to where the texts lie.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")
    )
    known = known.where(~held_out(F.col("_id"), folds, fold)).dropDuplicates(["_id"])
    total = known.count()
    if total > train_rows:
        known = known.where(F.xxhash64("_id", F.lit(SEED)) < F.lit(int(-(2**63) + train_rows / total * 2**64)))
    texts = docs.select(F.col(id_col).alias("_id"), whole(docs[text_col]).alias("text"))
    return texts.join(F.broadcast(known), "_id").select("label", "text")


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 4, fold: int = 2,
    id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS,
) -> Model:
    rows = gram_rows(sample(docs, labels, label_col, folds, fold, id_col, text_col, train_rows)).collect()
    found = [(r["label"], np.array(r["grams"], np.int64)) for r in rows]
    return fit(sorted(found, key=lambda r: (r[0], r[1].tobytes())))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row from its whole text; the score is the chance of label 1.

    A null text counts as empty, and an empty text has one n-gram that says so. Repeated
    rows get equal scores, a null id stays null, and an empty table gives no rows.
    """

    @F.pandas_udf("double")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = Grams()
        for texts in parts:
            yield pd.Series([model.score(grams.of(t)) for t in texts], dtype="float64")

    return docs.select(F.col(id_col), judged(whole(docs[text_col])).alias("score"))
