"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds its letters' vectors,
each permuted by its place, into one product; a text bundles its trigrams, each as often
as it occurs, into their sum. A language's prototype is the sum over its training texts,
and a text gets the language whose prototype has the greatest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import held_out, whole

DIMENSIONS = 1024
SEED = 20
#: Letters have codes below this; letters beyond the first planes share codes by hash.
LETTERS = 1024
PLACES = 3
#: Labelled rows that prototypes are learned from; of larger tables a hash picks so many on average.
TRAIN_ROWS = 6000
#: Texts are read in pieces of this many characters, so that any length fits.
CHUNK = 200_000
#: How sharply cosines become shares of certainty.
SHARPNESS = 12.0


def letter_vectors() -> np.ndarray:
    """(place, letter, dimension): each letter's vector, permuted once more for each earlier place."""
    first = np.random.default_rng(SEED).integers(0, 2, (LETTERS, DIMENSIONS), dtype=np.int8) * 2 - 1
    return np.stack([np.roll(first, PLACES - 1 - place, axis=1) for place in range(PLACES)]).astype(np.int8)


def letters_of(text: str) -> np.ndarray:
    """Codes of the lower-case letters, 0 for every run of anything else."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    known = _letter_table()
    is_letter = known[np.minimum(codes, len(known) - 1)]
    high = np.flatnonzero(codes >= len(known) - 1)
    for i in high:
        is_letter[i] = chr(codes[i]).isalpha()
    codes = np.where(is_letter, codes % (LETTERS - 1) + 1, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


_TABLE: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.array([chr(c).isalpha() for c in range(0x3000)] + [False]))
    return _TABLE[0]


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(trigram codes, counts) of a text padded by a blank each side; None without a letter."""
    text = text.lower()  # as a whole, since a letter's case may depend on its neighbours
    last, letters = np.zeros(1, np.int64), False
    names, counts = [], []
    for at in range(0, max(1, len(text)), CHUNK):
        codes = letters_of(text[at : at + CHUNK])
        letters = letters or bool(codes.any())
        if at and len(codes) and codes[0] == 0 and last[-1] == 0:
            codes = codes[1:]  # one run of other signs over the edge of a piece
        end = [0] if at + CHUNK >= len(text) else []
        codes = np.concatenate((last, codes, end)).astype(np.int64)
        found = np.unique((codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:], return_counts=True)
        names.append(found[0])
        counts.append(found[1])
        last = codes[-(PLACES - 1) :]
    if not letters:
        return None
    grams, where = np.unique(np.concatenate(names), return_inverse=True)
    return grams, np.bincount(where, np.concatenate(counts)).astype(np.int64)


def bundle(grams: np.ndarray, counts: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The sum of the bound trigram vectors, each as often as it occurs."""
    out = np.zeros(DIMENSIONS, np.float64)
    for at in range(0, len(grams), 4096):
        g, c = grams[at : at + 4096], counts[at : at + 4096]
        bound = letters[0, g // (LETTERS * LETTERS)] * letters[1, g // LETTERS % LETTERS]
        bound *= letters[2, g % LETTERS]
        out += c.astype(np.float32) @ bound.astype(np.float32)
    return out


def learn_prototypes(
    rows: DataFrame, id_col: str, text_col: str, lang_col: str, train_rows: int = TRAIN_ROWS
) -> dict[str, np.ndarray]:
    """language -> unit prototype, from ``train_rows`` rows on average, picked by a hash of the id.

    Every text's vector is first scaled to length one, so that long texts do not outweigh
    the rest. Each task sends one vector a language it has met, at most one a sampled row.
    """
    known = rows.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), whole(rows[text_col]).alias("text"), F.col(lang_col).alias("lang")
    )
    picked = known.withColumn("key", F.xxhash64("id", F.lit(SEED)))
    total = picked.select("id").count()
    if total > train_rows:
        picked = picked.where(F.col("key") < F.lit(int(-(2**63) + train_rows / total * 2**64)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letter_vectors()
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for text, lang in zip(frame["text"], frame["lang"]):
                if (found := trigram_counts(text)) is not None:
                    vector = bundle(*found, letters)
                    length = np.linalg.norm(vector)
                    if length:
                        sums[lang] = sums.get(lang, 0) + vector / length
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]})

    out: dict[str, np.ndarray] = {}
    for row in picked.select("text", "lang").mapInPandas(run, "lang string, vector array<double>").collect():
        out[row["lang"]] = out.get(row["lang"], 0) + np.array(row["vector"])
    return {k: out[k] / np.linalg.norm(out[k]) for k in sorted(out)}


def identify(
    docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) of every row, from the whole text.

    A null text, or one without a letter, is ``und`` with score 0; so is every text when
    no prototype was learned. Of equal cosines the first language by name wins. The
    score is the softmax share of the best cosine. Repeated rows get equal answers, a
    null id stays null, and an empty table gives no rows.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), DIMENSIONS)

    def answer(text: str, letters: np.ndarray) -> tuple[str, float]:
        found = trigram_counts(text) if names else None
        if found is None:
            return "und", 0.0
        vector = bundle(*found, letters)
        cosines = matrix @ vector / max(np.linalg.norm(vector), 1e-12)
        best = int(np.argmax(cosines))
        return names[best], float(1 / np.exp(SHARPNESS * (cosines - cosines[best])).sum())

    @F.pandas_udf("lang_pred string, score double")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_vectors()
        for texts in parts:
            got = [answer(t, letters) for t in texts]
            yield pd.DataFrame({"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]})

    rows = docs.select(F.col(id_col), judged(whole(docs[text_col])).alias("_judged"))
    return rows.select(F.col(id_col), "_judged.lang_pred", "_judged.score")


def train_and_identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, fold: int = 2
) -> DataFrame:
    """Learns from the rows outside the held-out fold and identifies every row."""
    prototypes = learn_prototypes(
        docs.where(~held_out(F.col(id_col), folds, fold)), id_col, text_col, lang_col
    )
    return identify(docs, prototypes, id_col, text_col)
