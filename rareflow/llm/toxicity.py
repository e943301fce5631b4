"""Toxic spans by a linear-chain conditional random field.

Tokens are words of a line, a line is one sequence, and every token is clean or toxic.
Labels of documents become labels of tokens first: in a toxic text, the words and word
beginnings that clean texts hardly have are toxic. The field's token scores come from a
word's identity, beginnings, ending and shape, its transitions from the two labels. The
forward and backward passes give each token's chance of being toxic; a logistic curve
over a text's largest chance and expected number of toxic tokens gives its score, and
runs of toxic tokens its spans.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import held_out, whole, written

#: Labelled rows that are learned from; of larger tables a hash picks so many on average.
TRAIN_ROWS = 6000
SEED = 1
#: A word or beginning is toxic if toxic texts have it at least so often, and so many times as often.
LEAST_TEXTS, LEAST_RATIO = 3, 8.0
#: The field is fitted on so many lines with a toxic token and without one, drawn by a hash.
MARKED_LINES, CLEAN_LINES = 15_000, 5000
#: Longer lines are cut after so many words for fitting (for scoring they are whole).
LINE_WORDS = 256
EPOCHS, BATCH_LINES, RATE, DECAY = 6, 128, 0.3, 1e-5
MEMO = 400_000
#: Sequences of one forward-backward pass hold about this many tokens together.
BATCH_TOKENS = 400_000
_EDGES = ".,;:!?\"'()[]{}*$%&#|"


def word_features(word: str) -> list[str]:
    """Features of a word: itself, beginnings of 3 to 8 letters, ending, case and length."""
    low = word.lower().strip(_EDGES) or word
    size = len(low)
    case = "#A" if word[:1].isupper() else "#a"
    return ["=" + low, "$" + low[-3:], case + str(min(size, 12)), *("^" + low[:n] for n in range(3, min(9, size)))]


def beginnings(word: str) -> list[str]:
    low = word.lower().strip(_EDGES)
    return ["=" + low, *("^" + low[:n] for n in range(4, 9) if len(low) > n)] if low else []


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odds of the label toxic: of each token given what stands before it, and given what stands after.

    ``scores`` holds the tokens' log weights of toxic against clean, sequence after
    sequence; ``lengths`` are the sequences' lengths, each at least one. All sequences
    advance together, one token a step, longest first, so that a step is a slice. The
    first odds include the token's own weight, so their product is the token's odds.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    (m00, m01), (m10, m11) = np.exp(moves)
    own = np.exp(np.clip(scores, -30, 30))
    before, after = own.copy(), np.ones(len(own))
    for t in range(1, steps):
        rows = starts[: active[t]] + t
        odds = before[rows - 1]
        before[rows] *= (m01 + m11 * odds) / (m00 + m10 * odds)
    for t in range(steps - 1, 0, -1):
        rows = starts[: active[t]] + t
        odds = own[rows] * after[rows]
        after[rows - 1] = (m10 + m11 * odds) / (m00 + m01 * odds)
    return before, after


def token_chances(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    before, after = forward_backward(scores, lengths, moves)
    odds = before * after
    return odds / (1 + odds)


def move_chances(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chance of toxic by token, expected number of moves from label to next label)."""
    before, after = forward_backward(scores, lengths, moves)
    odds = before * after
    inner = np.ones(len(scores), bool)
    inner[np.cumsum(lengths) - lengths] = False
    to = np.flatnonzero(inner)
    into = np.exp(np.clip(scores[to], -30, 30)) * after[to]
    first = np.stack([np.ones(len(to)), before[to - 1]], axis=1)
    second = np.stack([np.ones(len(to)), into], axis=1)
    joint = first[:, :, None] * np.exp(moves)[None] * second[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return odds / (1 + odds), joint.sum(axis=0)


@dataclass
class Field:
    """Weights of toxic against clean by feature, moves between labels, the score's curve."""

    bias: float
    weights: dict[str, float]
    moves: np.ndarray
    curve: np.ndarray
    memo: dict[str, float] = field(default_factory=dict, repr=False)

    def token_chances(self, words: list[str], lengths: list[int]) -> np.ndarray:
        """The chance of being toxic of each word of the lines one after another."""
        if not words:
            return np.zeros(0)
        memo, get = self.memo, self.weights.get
        if len(memo) > MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = self.bias + sum([get(f, 0.0) for f in word_features(w)])
        scores = np.fromiter(map(memo.__getitem__, words), np.float64, len(words))
        return token_chances(scores, np.array(lengths), self.moves)

    def document_score(self, evidence: np.ndarray) -> np.ndarray:
        z = evidence @ self.curve[:2] + self.curve[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def evidence_of(chances: np.ndarray) -> tuple[float, float]:
    """Log odds of the most toxic token, and log of one plus the expected number of toxic ones."""
    if not len(chances):
        return -10.0, 0.0
    top = min(max(float(chances.max()), 4.6e-5), 1 - 4.6e-5)
    return float(np.log(top / (1 - top))), float(np.log1p(chances[chances > 0.01].sum()))


def texts_to_chances(model: Field, texts: list[str]) -> Iterator[tuple[list[list[str]], np.ndarray]]:
    """(lines of words, chances of all words) of each text, many texts to a pass."""
    at = 0
    while at < len(texts):
        words: list[str] = []
        lengths: list[int] = []
        docs = []
        while at < len(texts) and (not docs or len(words) < BATCH_TOKENS):
            lines = [line.split() for line in texts[at].split("\n")]
            lines = [line for line in lines if line]
            begun = len(words)
            for line in lines:
                words += line
                lengths.append(len(line))
            docs.append((lines, begun, len(words)))
            at += 1
        chances = model.token_chances(words, lengths)
        for lines, a, b in docs:
            yield lines, chances[a:b]


def toxic_cues(rows: DataFrame, toxic: int, clean: int) -> set[str]:
    """Words and beginnings that the toxic texts have often and the clean texts hardly."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = [Counter(), Counter()]
            for label, text in zip(frame["label"], frame["text"]):
                counts[label].update({b for w in set(text.split()) for b in beginnings(w)})
            found = [(b, counts[1][b], counts[0][b]) for b in counts[0].keys() | counts[1].keys()]
            yield pd.DataFrame(found, columns=["cue", "toxic", "clean"])

    part = rows.mapInPandas(run, "cue string, toxic long, clean long")
    total = part.groupBy("cue").agg(F.sum("toxic").alias("n"), F.sum("clean").alias("m")).where(F.col("n") >= LEAST_TEXTS)
    often = F.col("n") / (toxic + 1) >= LEAST_RATIO * (F.col("m") + 0.5) / (clean + 1)
    return {r["cue"] for r in total.where(often & (F.col("m") * 8 <= F.col("n"))).select("cue").collect()}


def training_lines(rows: DataFrame, cues: set[str]) -> list[tuple[list[str], np.ndarray]]:
    """(words, labels) of ``MARKED_LINES`` lines with a toxic word and ``CLEAN_LINES`` without one at most.

    Only the drawn lines reach the driver.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known: dict[str, str] = {}
            out = []
            for label, text in zip(frame["label"], frame["text"]):
                for line in text.split("\n"):
                    words = line.split()
                    for at in range(0, len(words), LINE_WORDS):
                        some = words[at : at + LINE_WORDS]
                        if label:
                            for w in some:
                                if w not in known:
                                    known[w] = "1" if any(b in cues for b in beginnings(w)) else "0"
                        gold = "".join([known[w] for w in some]) if label else "0" * len(some)
                        out.append((" ".join(some), gold, "1" in gold))
            yield pd.DataFrame(out, columns=["line", "gold", "marked"])

    lines = rows.mapInPandas(run, "line string, gold string, marked boolean")
    lines = written(lines.withColumn("draw", F.xxhash64("line", F.lit(SEED))), "toxic-lines")
    drawn = []
    for marked, most in ((True, MARKED_LINES), (False, CLEAN_LINES)):
        drawn += lines.where(F.col("marked") == marked).orderBy("draw", "line", "gold").limit(most).collect()
    one = {}  # equal words share one string
    return [([one.setdefault(w, w) for w in r["line"].split(" ")], np.frombuffer(r["gold"].encode(), np.uint8) - 48) for r in drawn]


def fit_field(lines: list[tuple[list[str], np.ndarray]]) -> tuple[float, dict[str, float], np.ndarray]:
    """Bias, feature weights and moves that make the lines' labels likely, by AdaGrad on batches of lines.

    Features that a single word of the lines has are left out.
    """
    rng = np.random.default_rng(SEED)
    features = {w: word_features(w) for words, _ in lines for w in words}
    counts = Counter(f for found in features.values() for f in found)
    names = ["", *(f for f, n in counts.items() if n > 1)]
    number = {f: i for i, f in enumerate(names)}
    of_word = {w: np.array([0, *(number[f] for f in found if f in number)]) for w, found in features.items()}
    ids_of = [np.concatenate([of_word[w] for w in words]) for words, _ in lines]
    many_of = [np.array([len(of_word[w]) for w in words]) for words, _ in lines]
    weights, moves = np.zeros(len(names)), np.zeros((2, 2))
    seen_w, seen_m = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(lines)), max(1, len(lines) // BATCH_LINES)):
            gold = np.concatenate([lines[i][1] for i in batch])
            lengths = np.array([len(lines[i][1]) for i in batch])
            ids = np.concatenate([ids_of[i] for i in batch])
            owner = np.repeat(np.arange(len(gold)), np.concatenate([many_of[i] for i in batch]))
            chances, pairs = move_chances(np.bincount(owner, weights[ids], len(gold)), lengths, moves)
            slope = np.bincount(ids, (gold - chances)[owner], len(names)) / len(batch) - DECAY * weights
            inner = np.ones(len(gold), bool)
            inner[np.cumsum(lengths) - lengths] = False
            to = np.flatnonzero(inner)
            real = np.zeros((2, 2))
            np.add.at(real, (gold[to - 1], gold[to]), 1)
            move = (real - pairs) / len(batch) - DECAY * moves
            seen_w += slope**2
            seen_m += move**2
            weights += RATE * slope / np.sqrt(seen_w)
            moves += RATE * move / np.sqrt(seen_m)
    kept = {f: float(w) for f, w in zip(names[1:], weights[1:]) if abs(w) > 1e-3}
    return float(weights[0]), kept, moves


def fit_curve(evidence: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on the two pieces of evidence, by damped Newton steps."""
    x = np.column_stack([evidence, np.ones(len(labels))])
    beta = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (p - labels) + 0.1 * beta)
        beta -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def evidence_rows(rows: DataFrame, model: Field) -> np.ndarray:
    """(label, most toxic token, expected number) of each row, in an order of their own."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [evidence_of(c) for _, c in texts_to_chances(model, frame["text"].tolist())]
            most, many = zip(*found) if found else ((), ())
            yield pd.DataFrame({"label": frame["label"], "most": most, "many": many})

    found = rows.mapInPandas(run, "label int, most double, many double").collect()
    return np.array(sorted(map(tuple, found)), dtype=float).reshape(-1, 3)


def fit(rows: DataFrame) -> Field:
    """The field of the sampled (label, text) rows; without toxic rows every score is low.

    Words are counted, lines drawn and evidence worked out in tasks; the driver gets the
    cues, the drawn lines and three numbers a text.
    """
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts.get(1):
        return Field(-4.0, {}, np.zeros((2, 2)), np.array([0.0, 0.0, -4.0]))
    lines = training_lines(rows, toxic_cues(rows, counts[1], counts.get(0, 0)))
    model = Field(*fit_field(lines), np.zeros(3))
    found = evidence_rows(rows, model)
    model.curve = fit_curve(found[:, 1:], found[:, 0])
    return model


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, fold: int = 0,
    id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS,
) -> Field:
    """Learns from labelled rows outside the held-out fold, ``train_rows`` on average."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("label")
    )
    known = known.where(~held_out(F.col("_id"), folds, fold)).dropDuplicates(["_id"])
    total = known.count()
    if total > train_rows:
        known = known.where(F.xxhash64("_id", F.lit(SEED)) < F.lit(int(-(2**63) + train_rows / total * 2**64)))
    texts = docs.select(F.col(id_col).alias("_id"), whole(docs[text_col]).alias("text"))
    return fit(written(texts.join(F.broadcast(known), "_id").select("label", "text"), "toxic-sample"))


def _spans(lines: list[list[str]], chances: np.ndarray) -> list[tuple[int, int, float]]:
    """(first word, past the last word, largest chance) of runs of toxic words, counted over the text."""
    out, at = [], 0
    if not (chances >= 0.5).any():
        return out
    for line in lines:
        hot = np.flatnonzero(chances[at : at + len(line)] >= 0.5)
        for run in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1):
            if len(run):
                a, b = at + int(run[0]), at + int(run[-1]) + 1
                out.append((a, b, float(chances[a:b].max())))
        at += len(line)
    return out


def score(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans) of every row from its whole text.

    A span is (first word, past the last word, chance), words counted over the text.
    Null and blank texts have no token and get the score of no evidence. Repeated rows
    get equal scores, a null id stays null, and an empty table gives no rows.
    """

    @F.pandas_udf("score double, spans array<struct<first:int,past:int,chance:double>>")
    def judged(text: pd.Series) -> pd.DataFrame:
        evidence, spans = [], []
        for lines, chances in texts_to_chances(model, text.tolist()):
            evidence.append(evidence_of(chances))
            spans.append([dict(zip(("first", "past", "chance"), span)) for span in _spans(lines, chances)])
        scores = model.document_score(np.array(evidence).reshape(-1, 2))
        return pd.DataFrame({"score": scores, "spans": pd.Series(spans, dtype=object)})

    rows = docs.select(F.col(id_col), judged(whole(docs[text_col])).alias("_judged"))
    return rows.select(F.col(id_col), "_judged.score", "_judged.spans")


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more; all columns as they were.

    The verdict is worked out where the text lies and nothing is shuffled. Null, blank and
    empty texts have no toxic token and stay, repeated rows stay or go together, very long
    texts are read whole, and an empty table gives no rows.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col)

    @F.pandas_udf("boolean")
    def toxic(text: pd.Series) -> pd.Series:
        evidence = [evidence_of(c) for _, c in texts_to_chances(model, text.tolist())]
        return pd.Series(model.document_score(np.array(evidence).reshape(-1, 2)) >= least)

    return docs.where(~toxic(whole(docs[text_col])))
