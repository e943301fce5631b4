"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Runs on DataFrame functions only. The first scan keeps (length, prefix hash) a row;
rows whose length, then whose (length, prefix hash), is alone are unique. What survives
is written into bitmaps of a fixed total size that the second scan gets by broadcast:
only rows that they let through have their whole content hashed, where the row lies,
so no text is shuffled. The bitmaps never lose a survivor; one let through by chance
forms a group of its own in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import BLANK_RUN, numbered, whole, without_lines, written

PREFIX = 256
#: All bitmaps together: 2**25 bits, 1,024 bitmaps of 4 KB; their broadcast has this bound.
FILTER_BITS, BITMAP_BITS = 2**25, 32768


def normalised(text: Column) -> Column:
    """Each run of white space as one blank; null as the empty text."""
    return F.regexp_replace(whole(text), BLANK_RUN, " ")


def _slot(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(FILTER_BITS).cast("long"))


def _survivors(rows: DataFrame) -> DataFrame:
    """Bitmaps (bitmap, bits) of the (length, prefix hash) that more than one row has."""
    # rows are counted before any join, so that many copies of one text are one row from here on
    keys = written(rows.groupBy("length", "prefix").count(), "dedup-keys")
    lengths = keys.groupBy("length").agg(F.sum("count").alias("rows")).where("rows > 1").select("length")
    left = keys.join(lengths, "length", "left_semi").where("count > 1")
    slot = left.select(_slot(F.col("length"), F.col("prefix")).alias("slot"))
    return slot.groupBy((F.col("slot") / BITMAP_BITS).cast("int").alias("bitmap")).agg(
        F.bitmap_construct_agg(F.col("slot") % BITMAP_BITS).alias("bits")
    )


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (place % 8).cast("int")) == 1


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[Column] | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, and the ``carry`` columns.

    Rows are equal when their normalised texts are. The smallest id of a group stays;
    a null id counts as the smallest, and of rows with the same id and text one stays.
    Empty, blank-free null and very long texts are texts like any other. An empty table
    gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        normalised(docs[text_col]).alias("norm"),
        *(c for c in carry or []),
    )
    more = rows.columns[2:]
    rows = rows.withColumns(
        {"length": F.length("norm"), "prefix": F.xxhash64(F.substring("norm", 1, PREFIX))}
    )
    maps = F.broadcast(_survivors(rows))
    place = F.col("slot") % BITMAP_BITS
    seen = (
        rows.withColumn("slot", _slot(F.col("length"), F.col("prefix")))
        .withColumn("bitmap", (F.col("slot") / BITMAP_BITS).cast("int"))
        .join(maps, "bitmap", "left")
        .withColumn("maybe", F.coalesce(_is_set(F.col("bits"), place), F.lit(False)))
        .select(
            "id",
            F.when(F.col("maybe"), F.sha2(F.col("norm"), 256)).alias("full"),
            F.monotonically_increasing_id().alias("line"),
            *more,
        )
    )
    seen = written(seen, "dedup-rows")
    alone = seen.where("full is null").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *more
    )
    members = seen.where("full is not null")
    groups = members.groupBy("full").agg(
        F.min(F.struct("id", "line")).alias("first"), F.count("*").alias("group_size")
    )
    together = members.join(groups, "full").select(
        "id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("line") == F.col("first.line")).alias("kept"),
        *more,
    )
    return alone.unionByName(together).withColumnRenamed("id", id_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    The row of smallest id stays (a null id counts as the smallest), of rows that repeat
    the id one. Null, empty and very long texts are texts like any other; an empty table
    gives no rows. Rows are dropped by a key of their own, which is stored with them.
    """
    rows, line = numbered(docs, "dedup-lines")
    verdict = exact_groups(rows, id_col, text_col, [F.col(line).alias("_line")])
    return without_lines(rows, line, written(verdict.where("not kept").select("_line"), "dedup-dropped"))
