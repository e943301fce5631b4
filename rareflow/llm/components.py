"""Connected components by alternating large-star and small-star passes.

Each pass is a grouped minimum and a join on the written edges; nothing but two numbers
of each pass reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import written

#: Passes needed grow with the log of the longest chain; more than this means a fault.
MOST_PASSES = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the long pairs (u, v): the smallest node it reaches.

    Loops and repeated pairs do no harm; nodes without a pair to another have no row.
    """
    now = written(_small_star(edges.select("u", "v")), "stars")
    state = _state(now)
    for _ in range(MOST_PASSES):
        now = written(_small_star(_large_star(now)), "stars")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
