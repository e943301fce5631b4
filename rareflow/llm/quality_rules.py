"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Runs on DataFrame functions only. Every rule is a boolean expression on the text. A
bounded sample of rows tells what share each rule rejects and how long it takes; the
rules then stand in one CASE, most rejection per second first, whose evaluation Spark
ends at the first rule that rejects. The verdict does not depend on the order, only the cost does.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import whole, words

SYMBOLS = "[#*$%&|<>]"
SEPARATORS = ("|", "<", ">", "•", "-")
WINDOW = 5
#: Rows of the sample that costs and selectivities come from.
SAMPLE_ROWS = 500
#: A rule's cost counts once it takes this share of an empty rule's time more, or so many repeats.
CLEAR, MOST_TIMES = 0.5, 128
SEED = 4


def _count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in the character class ``chars``."""
    return (F.length(text) - F.length(F.regexp_replace(text, chars, ""))).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))


def window_hashes(w: Column) -> Column:
    """A 64-bit hash for each five-word window of an array of words; null below five words."""
    starts = F.when(F.size(w) >= WINDOW, F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(-1, WINDOW - 1))))


def sorted_windows(hashes: Column) -> Column:
    return F.array_sort(F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(1), F.size(hashes)).alias("i")))


def repeated_places(pairs: Column) -> Column:
    """Positions, in order, of the sorted windows whose neighbour has the same hash."""

    def place(p: Column, k: Column) -> Column:
        same = p["h"].eqNullSafe(F.get(pairs, k - 1)["h"]) | p["h"].eqNullSafe(F.get(pairs, k + 1)["h"])
        return F.when(same, p["i"])

    return F.array_sort(F.filter(F.transform(pairs, place), lambda p: p.isNotNull()))


def covered_words(places: Column) -> Column:
    """How many words the windows at these positions cover together."""
    reach = F.transform(
        places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))
    )
    return F.aggregate(reach, F.lit(0), lambda a, b: a + b)


def base_columns(rows: DataFrame) -> DataFrame:
    """Adds words, n_lines and the base counts (long) to (id, text).

    The steps are columns of their own, so that a lambda refers to a finished array
    instead of working it out again for every element. Only texts with an equal pair of
    window hashes have their windows sorted.
    """
    out = rows.withColumns({"words": words(F.col("text")), "lines": lines_with_words(F.col("text"))})
    out = out.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": _count(F.col("text"), SYMBOLS),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "hashes": window_hashes(F.col("words")),
        }
    ).drop("lines")
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    out = out.withColumn("pairs", F.when(again, sorted_windows(F.col("hashes")))).drop("hashes")
    out = out.withColumn("places", repeated_places(F.col("pairs"))).drop("pairs")
    covered = F.coalesce(covered_words(F.col("places")), F.lit(0)).cast("long")
    return out.withColumn("n_repeat_words", covered).drop("places")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


#: name -> whether a text is rejected, on its words and base counts.
RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: F.col("n_symbols") * 4 > F.col("word_chars"),
    "separators": lambda: F.size(F.filter("words", lambda w: w.isin(*SEPARATORS))) * 4 > F.col("n_words"),
    "capitals": lambda: _count(F.col("text"), "[A-Z]") * 2 > F.length("text"),
    "exclamations": lambda: _count(F.col("text"), "!") > F.col("n_words"),
    "duplicate_lines": lambda: F.col("n_dup_lines") * 2 > F.col("n_lines"),
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 25 * F.col("n_words")),
}


def sampled(docs: DataFrame, text_col: str, rows: int) -> DataFrame:
    """About ``rows`` texts, drawn by a hash of their place, so that a sorted table biases nothing."""
    share = min(1.0, rows / max(1, docs.count()))
    highest = min(2**63 - 1, int(-(2**63) + share * 2**64))
    place = F.xxhash64(F.monotonically_increasing_id(), F.lit(SEED))
    return docs.select(whole(docs[text_col]).alias("text"), place.alias("place")).where(F.col("place") <= F.lit(highest)).drop("place")


def _seconds(sample: DataFrame, rule: Column, times: int) -> float:
    """The median time of three runs of one task that works ``rule`` out ``times`` times on each row."""
    again = sample.withColumn("_time", F.explode(F.sequence(F.lit(1), F.lit(times))))
    job = again.agg(F.sum(F.when(rule, 1).otherwise(0)))
    spent = []
    for _ in range(3):
        begun = time.perf_counter()
        job.collect()
        spent.append(time.perf_counter() - begun)
    return sorted(spent)[1]


def rule_costs(sample: DataFrame, rules: dict[str, Callable[[], Column]]) -> dict[str, float]:
    """Seconds that each rule takes on a row, over those of a rule that does nothing.

    A rule is repeated until its time stands clear of the empty rule's, or ``MOST_TIMES``.
    """
    rows = max(1, sample.count())
    empty: dict[int, float] = {}
    out = {}
    for name, rule in rules.items():
        times = 8
        while True:
            if times not in empty:
                empty[times] = _seconds(sample, F.length("text") < 0, times)
            spent = _seconds(sample, rule(), times) - empty[times]
            if spent > CLEAR * empty[times] or times >= MOST_TIMES:
                break
            times *= 4
        out[name] = max(spent, 1e-6) / (times * rows)
    return out


def ordered_rules(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejected share per second, estimated on a hashed sample of about ``sample_rows`` rows.

    An empty table keeps the order in which the rules are written.
    """
    spark = docs.sparkSession
    found = [(r["text"],) for r in sampled(docs, text_col, sample_rows).limit(2 * sample_rows).collect()]
    if not found:
        return list(RULES)
    sample = base_columns(spark.createDataFrame(found, "text string").coalesce(1)).persist()
    try:
        shares = sample.agg(*(F.avg(F.when(rule(), 1.0).otherwise(0.0)).alias(name) for name, rule in RULES.items())).first()
        costs = rule_costs(sample, RULES)
    finally:
        sample.unpersist()
    return sorted(RULES, key=lambda name: (-(shares[name] or 0.0) / costs[name], name))


def rejected(order: list[str]) -> Column:
    """The cascade: true at the first rule in ``order`` that rejects."""
    verdict = F.lit(False)
    for name in reversed(order):
        verdict = F.when(RULES[name](), F.lit(True)).otherwise(verdict)
    return verdict


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: list[str] | None = None
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    Null text counts as empty; empty and blank texts have no words and fail the base.
    Rows are judged one by one, so ties and repeated rows get equal verdicts, a null id
    stays null and an empty table gives no rows.
    """
    order = ordered_rules(docs, text_col) if order is None else order
    rows = docs.select(F.col(id_col).alias("id"), whole(docs[text_col]).alias("text"))
    out = base_columns(rows).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~rejected(order))
    return out.withColumn("kept", kept).drop("text", "words", "n_lines").withColumnRenamed("id", id_col)
