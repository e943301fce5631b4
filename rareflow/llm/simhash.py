"""SimHash near-dedup with pivot distance tables.

Every fingerprint carries its Hamming distances to fixed reference fingerprints. By the
triangle inequality two fingerprints at distance d differ by at most d in each of these,
so a candidate pair is discarded by its largest coordinate difference before its own
distance is worked out.

``linked_fingerprints`` links all fingerprints at ``RADIUS`` or fewer differing bits.
Candidates share two of four 16-bit blocks, which any such pair does. A bucket of at
most ``SMALL`` fingerprints gives its pairs; the fingerprints of larger buckets are put
on each point of the ball of radius one around them instead, where two of them meet
exactly if they are at distance two or less. A point holds at most 65 fingerprints, so
no group's size grows any list, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import free_name, numbered, whole, without_lines, written
from rareflow.llm.components import components

SEED = 42
RADIUS = 2
PIVOTS = 12
BLOCKS, BLOCK_BITS = 4, 16
SMALL = 32
#: Shingles whose hashes are worked on at a time, so that a text of any length fits.
CHUNK = 65_536


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``size`` words, lower-cased A to Z, in order.

    Fewer words make one shingle of them all; no word makes none.
    """
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined, one = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    return np.fromiter((one(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that over half the hashes have, as a signed 64-bit number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_of(text: Column, size: int) -> Column:
    """The fingerprint of a whole text; the other columns of its row stay on the JVM side."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes(t, size)) for t in texts], dtype="int64")

    return run(whole(text))


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints: the first outputs of the splitmix64 generator, signed."""
    out, state, mask = [], 0, 2**64 - 1
    for _ in range(count):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        z ^= z >> 31
        out.append(z - 2**64 if z >= 2**63 else z)
    return out


def with_pivots(df: DataFrame, fp: str = "fp") -> DataFrame:
    """Adds the pivot table: the distance of ``fp`` to each reference fingerprint."""
    near = {f"p{i}": F.bit_count(F.col(fp).bitwiseXOR(F.lit(p))).cast("byte") for i, p in enumerate(pivots())}
    return df.withColumns(near)


def may_be_near(radius: int) -> Column:
    """Whether no pivot coordinate of the rows a and b differs by more than ``radius``."""
    out = F.lit(True)
    for i in range(PIVOTS):
        out = out & (F.abs(F.col(f"a.p{i}").cast("int") - F.col(f"b.p{i}")) <= radius)
    return out


def are_near(radius: int) -> Column:
    return F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius


def _block_keys(fps: DataFrame) -> DataFrame:
    """Every fingerprint under each pair of its blocks: (part, key, fp)."""
    block = [F.shiftright("fp", BLOCK_BITS * i).bitwiseAND((1 << BLOCK_BITS) - 1) for i in range(BLOCKS)]
    pairs = [(i, j) for i in range(BLOCKS) for j in range(i)]
    keys = [
        F.struct(F.lit(n).alias("part"), F.shiftleft(block[i], BLOCK_BITS).bitwiseOR(block[j]).alias("key"))
        for n, (i, j) in enumerate(pairs)
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.part", "k.key", "fp")


def linked_fingerprints(fps: DataFrame) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints which links of ``RADIUS`` connect.

    ``fps`` holds each fingerprint once.
    """
    keys = _block_keys(fps)
    sizes = keys.groupBy("part", "key").count().where("count > 1")
    shared = written(keys.join(sizes, ["part", "key"]), "simhash-shared")
    small = with_pivots(shared.where(F.col("count") <= SMALL))
    pairs = (
        small.alias("a")
        .join(small.alias("b"), ["part", "key"])
        .where(F.col("a.fp") < F.col("b.fp"))
        .where(may_be_near(RADIUS))
        .where(are_near(RADIUS))
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
        .distinct()
    )
    crowded = shared.where(F.col("count") > SMALL).select("fp").distinct()
    around = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(2**63)).cast("long") for i in range(64)))
    ball = crowded.select("fp", F.explode(around).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp"
    )
    meeting = ball.groupBy("point").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    stars = meeting.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u < v").distinct()
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fp (long), component_id.

    The component's id is the smallest id that links of fingerprints reach, the row's own
    included. Texts without words, null ones too, have fingerprint zero and link like any
    other. Rows with a null id belong to their component but never name it unless all
    its ids are null. Repeated rows each get a row; an empty table gives none.
    """
    rows = docs.select(F.col(id_col).alias("id"), fingerprint_of(docs[text_col], size).alias("fp"))
    prints = written(rows, "simhash-prints")
    firsts = prints.groupBy("fp").agg(F.min("id").alias("first"))
    firsts = written(firsts, "simhash-distinct")
    roots = components(linked_fingerprints(firsts.select("fp")))
    named = firsts.join(roots, firsts["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    verdict = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(verdict, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints, all columns as they were.

    The row of smallest id stays, a null id coming last; of rows that repeat the id, the
    one that comes first. Rows count by themselves, so an id that two texts share drops
    neither. Texts without words are one group. An empty table gives no rows.
    """
    fp = free_name(docs, "fingerprint")
    rows, line = numbered(docs, "simhash-rows", **{fp: fingerprint_of(docs[text_col], size)})
    prints = rows.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"), F.col(line).alias("line"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "line")
    firsts = written(prints.groupBy("fp").agg(F.min(place).alias("first")), "simhash-distinct")
    roots = components(linked_fingerprints(firsts.select("fp")))
    named = firsts.join(roots, firsts["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    keep = named.groupBy("root").agg(F.min("first").alias("first"))
    stays = written(keep.select("first.line"), "simhash-kept")
    doomed = prints.select("line").join(stays, "line", "left_anti")
    return without_lines(rows.drop(fp), line, written(doomed, "simhash-dropped"))
