"""What the corpus operators share: text columns, written intermediates, ranks at scale.

Conventions: a null text counts as empty; only the named columns of the input are
read, so extra columns with any names do no harm; rows are never merged by id unless
an operator says so.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rareflow.session import fresh_path

#: White space as the contracts define it: a blank and the control codes 9 to 13.
BLANK_RUN = r"[\x20\x09-\x0D]+"

#: Keys (8 bytes each) that are sent to every task at most.
BROADCAST_KEYS = 1_000_000

#: Rows that one task of a ranked window should hold, and the most buckets of a group.
BUCKET_ROWS, MOST_BITS = 1000, 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array, JVM side."""
    return F.array_remove(F.split(whole(text), BLANK_RUN), "")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe from lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it if ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def numbered(df: DataFrame, label: str, **more: Column) -> tuple[DataFrame, str]:
    """(``df`` as a written table with a key of its own for each row, the key's name).

    The key is stored with the row, so it stays the same however later scans are cut.
    ``more`` columns are worked out on the way; their names must be free.
    """
    line = free_name(df, "line_number")
    return written(df.withColumns({line: F.monotonically_increasing_id(), **more}), label), line


def without_lines(rows: DataFrame, line: str, doomed: DataFrame) -> DataFrame:
    """``rows`` without those whose key is in ``doomed`` (one column, distinct), the key dropped.

    So few doomed keys are broadcast; more are joined by key.
    """
    keys = doomed.toDF("_doomed")
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return rows.join(keys, F.col(line) == F.col("_doomed"), "left_anti").drop(line)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold that nothing learns from."""
    rest = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
    return rest == fold


def spread_bits(rows: int) -> int:
    """Bits of a hash that cut ``rows`` into buckets of about ``BUCKET_ROWS``."""
    return max(0, min(MOST_BITS, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS))))


def running_total(
    df: DataFrame, groups: list[str], order: list[str], value: Column, name: str, bits: int
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the earlier rows of the group.

    ``order`` starts with a column holding an evenly spread signed 64-bit hash. A group
    is cut by the hash's top bits, so that a group of any size is spread over many
    tasks; the totals of its buckets (at most 2**MOST_BITS a group) give each bucket's
    start.
    """
    top = F.shiftright(F.col(order[0]), 64 - bits) if bits else F.lit(0).cast("long")
    rows = df.withColumns({"_bucket": top, "_value": value})
    keys = [*groups, "_bucket"]
    starts = rows.groupBy(keys).agg(F.sum("_value").alias("_sum"))
    along = Window.partitionBy(groups).orderBy("_bucket")
    starts = starts.select(*keys, (F.sum("_sum").over(along) - F.col("_sum")).alias("_start"))
    starts = starts.select(*(F.col(k).alias(f"_g_{k}") for k in keys), "_start")
    inside = Window.partitionBy(keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_inside", F.sum("_value").over(inside) - F.col("_value"))
    on = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    out = rows.join(starts, on, "inner")
    return out.select(*df.columns, (F.col("_start") + F.col("_inside")).alias(name))
