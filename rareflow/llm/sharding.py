"""Sharding by balanced label propagation.

Rows are linked if their texts are equal. Every row starts in a shard by its rank in a
hashed order, so that counts differ by one at most. In each round a linked row asks for
the shard that most of its group is in; the number of rows that may go from one shard
to another is matched by as many that go back, other rows that ask for it first and rows
without a link after them, so the counts never change. A group larger than half a shard
is propagated as parts of that size, because it cannot lie in one shard.

Rounds are joins and grouped counts on narrow rows. Only the table of moves asked for,
shards times shards, reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import running_total, spread_bits, whole, written

SHARDS = 24
ROUNDS = 6
SEED = 7


def _rank(df: DataFrame, groups: list[str], bits: int, name: str) -> DataFrame:
    """Adds the row's rank, from 0, in the hashed order within its group."""
    return running_total(df, groups, ["key", "line"], F.lit(1).cast("long"), name, bits)


def quotas(wanted: dict[tuple[int, int], int], spare: dict[int, int], shards: int) -> tuple[dict, dict]:
    """(linked, filling): rows that may go from shard to shard, by pair of shards.

    For every pair of shards as many rows go one way as the other. Rows that ask for
    the move come first; the rest of the larger side is matched by unlinked rows of the
    other shard, as far as it has some left.
    """
    linked, filling, left = {}, {}, dict(spare)
    pairs = [(a, b) for a in range(shards) for b in range(a)]
    pairs.sort(key=lambda p: (-(wanted.get(p, 0) + wanted.get(p[::-1], 0)), p))
    for a, b in pairs:
        there, back = wanted.get((a, b), 0), wanted.get((b, a), 0)
        if there < back:
            a, b, there, back = b, a, back, there
        fill = min(there - back, left.get(b, 0))
        left[b] = left.get(b, 0) - fill
        linked[a, b], linked[b, a], filling[b, a] = back + fill, back, fill
    return {k: n for k, n in linked.items() if n}, {k: n for k, n in filling.items() if n}


def _round(rows: DataFrame, shards: int, bits: int) -> DataFrame | None:
    """The rows (line, key, part, shard) after one round of moves; None if no move is allowed."""
    held = rows.where("part is not null").groupBy("part", "shard").count()
    best = held.groupBy("part").agg(
        F.max(F.struct("count", F.xxhash64("part", "shard").alias("draw"), "shard")).alias("top")
    )
    best = best.select("part", F.col("top.shard").alias("goal"))
    # rows without a part stay out of the join, where null would be one key for most of them
    linked = rows.where("part is not null").join(best, "part").select(*rows.columns, "goal")
    alone = rows.where("part is null").withColumn("goal", F.lit(None).cast("int"))
    asked = written(linked.unionByName(alone), "shard-asked")
    moving = asked.where("goal <> shard")
    wanted = {(r["shard"], r["goal"]): r["count"] for r in moving.groupBy("shard", "goal").count().collect()}
    spare = {r["shard"]: r["count"] for r in asked.where("part is null").groupBy("shard").count().collect()}
    linked, filling = quotas(wanted, spare, shards)
    if not linked:
        return None
    # rows that ask, in hashed order up to the quota of their pair of shards
    ask = F.broadcast(_table(rows, [(a, b, n) for (a, b), n in linked.items()], "shard int, goal int, quota long"))
    ranked = _rank(moving, ["shard", "goal"], bits, "rank").join(ask, ["shard", "goal"], "left")
    goes = ranked.select(
        "line", "key", "part", F.when(F.col("rank") < F.col("quota"), F.col("goal")).otherwise(F.col("shard")).alias("shard")
    )
    # unlinked rows, in hashed order, to one shard after another
    spans, at = [], {}
    for (a, b), n in sorted(filling.items()):
        spans.append((a, b, at.get(a, 0), at.get(a, 0) + n))
        at[a] = at.get(a, 0) + n
    free = _rank(asked.where("part is null").drop("goal"), ["shard"], bits, "rank")
    if spans:
        # a few spans a shard: an array of at most SHARDS entries beside each row, no range join
        table = _table(rows, spans, "shard int, to int, low long, high long").groupBy("shard").agg(
            F.collect_list(F.struct("to", "low", "high")).alias("spans")
        )
        free = free.join(F.broadcast(table), "shard", "left")
        hit = F.get(F.filter("spans", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"])), F.lit(0))
        free = free.withColumn("shard", F.coalesce(hit["to"], F.col("shard")))
    stays = asked.where("part is not null and goal = shard").select("line", "key", "part", "shard")
    return goes.unionByName(stays).unionByName(free.select("line", "key", "part", "shard"))


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def shard_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    The law is ``rows``: counts of shards differ by one at most, whatever is linked.
    Slots number a shard's rows from 0. Null texts have size 8, are equal to empty ones
    and link with them. Repeated rows are rows of their own; a null id stays null; an
    empty table gives no rows. With fewer rows than shards some shards are empty.
    """
    text = whole(docs[text_col])
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("line"),
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("text_hash"),
        ).withColumn("key", F.xxhash64("id", "text_hash", F.lit(SEED))),
        "shard-rows",
    )
    n = rows.count()
    bits = spread_bits(n)
    most = max(2, -(-n // (2 * shards)))
    groups = rows.groupBy("text_hash").count().where("count > 1").select("text_hash")
    linked = rows.join(groups, "text_hash").select("line", "key", "text_hash")
    linked = _rank(linked, ["text_hash"], bits, "rank").select(
        "line", F.xxhash64("text_hash", F.expr(f"rank div {most}")).alias("part")
    )
    start = _rank(rows.select("line", "key"), [], bits, "rank") if n else rows.select("line", "key").withColumn("rank", F.lit(0))
    state = start.join(linked, "line", "left").select(
        "line", "key", "part", (F.col("rank") % shards).cast("int").alias("shard")
    )
    state = written(state, "shard-state")
    for _ in range(rounds):
        after = _round(state, shards, bits)
        if after is None:
            break
        state = written(after, "shard-state")
    slots = _rank(state.select("line", "key", "shard"), ["shard"], bits, "slot")
    return rows.join(slots.select("line", "shard", "slot"), "line").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
