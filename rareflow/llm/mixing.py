"""Mixing sources to target weights by a low-discrepancy schedule.

A source has as many slots as its target has blocks of equally many words, the last one
cut at the target, so it gives just its target however small. Slot t stands at the golden
ratio's multiple t * phi, modulo one; the sources share the slots in the order of these
points, so any run of slots is close to the shares. The slots of a source are ranked, its
documents stand in a shuffled order, three passes at most, cut into blocks, and the k-th
slot is joined with the k-th block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rareflow.llm.common import free_name, numbered, running_total, spread_bits, whole, words, written
from rareflow.session import range_count

GOLDEN = (math.sqrt(5) - 1) / 2
WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often.
MOST_PASSES = 3
#: The schedule has about ``SLOTS`` slots, and more once blocks would hold over ``MOST_BLOCK`` words.
SLOTS, MOST_BLOCK = 65_536, 4096
#: Numbers of one source that are spelled out together.
NUMBERS_APART = 8192
#: Sources that are sent to every task at most; more are joined.
BROADCAST_SOURCES = 100_000
SEED = 9


def word_count(text: Column) -> Column:
    return F.size(words(whole(text))).cast("long")


def targets(sizes: dict, weights: tuple = WEIGHTS, most: int = MOST_PASSES) -> dict:
    """source -> words to take: shares of all words by weight, none above ``most`` times its size.

    Sources stand by code point, null last, and get the weights in turn. What a source
    cannot take is shared among the others by weight until none is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, list(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = float(most * sizes[s])
            free.remove(s)
        left -= sum(out[s] for s in over)
    return {s: out[s] for s in names}


def block_words(total: int) -> int:
    return int(min(MOST_BLOCK, max(1, total // SLOTS)))


def whole_words(goal: dict) -> dict:
    """source -> target in whole words; a source with words gives one at least."""
    return {s: max(1, round(g)) if g > 0 else 0 for s, g in goal.items()}


def numbers_of(spark: SparkSession, counts: list[int]) -> DataFrame:
    """(number, place): 0, 1, 2, ... dealt out, ``counts[i]`` in a row to the place i."""
    runs, first = [], 0
    for place, count in enumerate(counts):
        runs.append((place, first, first + count))
        first += count
    table = spark.createDataFrame(runs, "place int, first long, past long").where("first < past")
    # a place of many numbers is cut into parts first, so that no task spells it out alone
    parts = table.withColumn("from", F.explode(F.expr(f"sequence(first, past - 1, {NUMBERS_APART}L)")))
    parts = parts.repartition(range_count(spark), "from")
    past = F.least(F.col("past"), F.col("from") + NUMBERS_APART)
    return parts.select(F.explode(F.sequence(F.col("from"), past - 1)).alias("number"), "place")


def schedule(df: DataFrame, counts: list[int]) -> DataFrame:
    """(slot, place, rank): the place of each slot's source and its rank among that source's slots.

    The place i has exactly ``counts[i]`` slots: the slots are numbered in the order of
    their points, and each place has the next ``counts[i]`` numbers.
    """
    spark, slots = df.sparkSession, sum(counts)
    # the point, modulo one, as an evenly spread signed integer
    point = F.expr(f"cast((pmod((id + 0.5D) * {GOLDEN!r}D, 1.0D) - 0.5D) * {2.0**64!r}D as long)")
    points = spark.range(slots).select(point.alias("point"), F.col("id").alias("slot"))
    rows = running_total(points, [], ["point", "slot"], F.lit(1).cast("long"), "number", spread_bits(slots))
    rows = rows.join(numbers_of(spark, counts), "number").select("slot", "place")
    # ranks: counts in runs of slots, then inside each run, so no source's slots meet in one task
    run = max(1024, slots // 65_536)
    rows = rows.withColumn("run", (F.col("slot") / run).cast("long"))
    counts = rows.groupBy("place", "run").count()
    along = Window.partitionBy("place").orderBy("run")
    starts = counts.select("place", "run", (F.sum("count").over(along) - F.col("count")).alias("start"))
    inside = Window.partitionBy("place", "run").orderBy("slot")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1)
    return rows.join(starts, ["place", "run"]).select("slot", "place", (F.col("start") + F.col("inside")).alias("rank"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", line: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces) of the mix.

    rows: line, id, size, source, source_size, target, one per row of ``docs``. pieces:
    slot, line, pass, start, length: the words of a row that a slot takes. A null text
    has no words; rows without words are in no piece. A null source is a source of its
    own, the last. Repeated rows are rows of their own. Empty tables give empty results.
    ``line`` is a stored key of each row; by default rows are numbered here. The driver
    sees one row for each source.
    """
    rows = docs.select(
        (F.monotonically_increasing_id() if line is None else line).alias("line"),
        F.col(id_col).alias("id"),
        word_count(docs[text_col]).alias("size"),
        F.col(source_col).cast("string").alias("source"),
    )
    rows = written(rows, "mix-rows")
    by_source = {r["source"]: (int(r["words"]), r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()}
    sizes = {s: w for s, (w, _) in by_source.items()}
    goal = targets(sizes)
    names, total, take = list(goal), sum(sizes.values()), whole_words(goal)
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(i, s, sizes[s], goal[s], take[s]) for i, s in enumerate(names)],
        "place int, source string, source_size long, target double, goal long",
    )
    small = len(names) <= BROADCAST_SOURCES
    placed = rows.join(F.broadcast(table) if small else table, rows["source"].eqNullSafe(table["source"]), "left").select(
        "line", "id", "size", rows["source"], "source_size", "target", "place", "goal"
    )
    if not total:
        none = placed.limit(0).select(
            F.col("line").alias("slot"), "line", F.col("place").alias("pass"), F.col("size").alias("start"), F.col("size").alias("length")
        )
        return placed.drop("place", "goal"), none
    block = block_words(total)
    plan = schedule(docs, [-(-take[s] // block) for s in names])
    order = placed.where("size > 0").withColumn("key", F.xxhash64("id", "size", F.lit(SEED)))
    along = running_total(
        order.select("place", "key", "line", "size", "source_size", "goal"), ["place"], ["key", "line"],
        F.col("size"), "before", spread_bits(sum(n for _, n in by_source.values())),
    )
    passes = along.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1))))
    passes = passes.withColumn("at", F.col("before") + F.col("pass") * F.col("source_size"))
    passes = passes.where("at < goal").withColumn("until", F.least(F.col("at") + F.col("size"), F.col("goal")))
    last = F.expr(f"(until - 1) div {block}")
    cut = passes.withColumn("rank", F.explode(F.sequence(F.expr(f"at div {block}"), last)))
    begin = F.greatest(F.col("at"), F.col("rank") * block)
    end = F.least(F.col("until"), (F.col("rank") + 1) * block)
    cut = cut.select("place", "rank", "line", "pass", (begin - F.col("at")).alias("start"), (end - begin).alias("length"))
    return placed.drop("place", "goal"), plan.join(cut, ["place", "rank"]).select("slot", "line", "pass", "start", "length")


def taken(docs: DataFrame, **columns) -> DataFrame:
    """(id, size, source, source_size, target, taken): words the mix takes of each row, repeats counted."""
    rows, pieces = mix(docs, **columns)
    sums = pieces.groupBy("line").agg(F.sum("length").alias("taken"))
    return rows.join(sums, "line", "left").select(
        "id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix reads them: each row once for every pass that takes its first word.

    Rows without words stay once. All columns are kept as they were; rows, repeated ones
    too, are told apart by a key that is stored with them. An empty table gives no rows.
    """
    stored, line = numbered(docs, "mix-lines")
    rows, pieces = mix(stored, id_col, text_col, source_col, F.col(line))
    times = pieces.where("start = 0").groupBy("line").agg(F.countDistinct("pass").alias("times"))
    often = rows.select("line", "size").join(times, "line", "left").select(
        F.col("line").alias("_of"),
        F.when(F.col("size") > 0, F.coalesce("times", F.lit(0))).otherwise(1).cast("int").alias("_times"),
    )
    names = [free_name(stored, c) for c in ("mix_of", "mix_times", "mix_copy")]
    often = often.where("_times > 0").toDF(*names[:2])
    out = stored.join(often, stored[line] == F.col(names[0]))
    return out.withColumn(names[2], F.explode(F.sequence(F.lit(1), F.col(names[1])))).select(*(f"`{c}`" for c in docs.columns))
