"""The trie of conversation prefixes, by a skeleton of splitter paths and sorted shards.

Conversations are paths of turns. Splitters, rows of a sample in sorted order, cut the
sorted paths into shards of about equal size; the trie of the splitters' own paths is
the skeleton, and it is broadcast. A node whose members lie on both sides of a splitter
is a prefix of that splitter, so every other node lies in one shard whole. Each shard
streams its sorted paths past a stack of open nodes: nodes off the skeleton are finished
there, nodes on it leave partial aggregates that are reduced over the shards and then
summed from the deepest to the root. Equal paths are told apart by conv_id, so copies of
one conversation, however many, spread over several shards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.llm.common import whole, written
from rareflow.session import range_count

#: Conversations that a base conversation lends its first turns to, and the most turns it lends.
BLOCK, MOST_HEAD = 100, 6
#: Conversations of one shard, sampled rows for each splitter, turns of a splitter's path.
SHARD_ROWS, SAMPLES, SPLITTER_TURNS = 50_000, 20, 1024
#: Hex digits of a turn's digest in a path.
DIGITS = 32
#: Rows handed to Spark at once, and characters of a list of ids in one row.
BATCH_ROWS, CHUNK = 20_000, 1 << 16

NODE = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, skeleton int, size long, shard int, chunk long, ids string"
)
RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
NOTHING = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): each conversation after it took the first turns of its block's base.

    A path is the turns' digests one after another; sizes are the turns' code points.
    Turns are ordered by turn (null first), equal ones by digest. Null role or text is
    empty. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    digest = F.substring(F.sha2(F.concat_ws(":", F.length(role), role, text), 256), 1, DIGITS)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.struct("turn", digest.alias("digest"), F.length(text).alias("size")).alias("t")
    )
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    heads = convs.where(F.col("conv_id") % BLOCK == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, MOST_HEAD - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % MOST_HEAD).cast("int")
    convs = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % BLOCK, "h": h}).join(heads, "base", "left")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h")))
    own = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    convs = convs.select("conv_id", F.concat(F.coalesce(head, F.slice("own", 1, 0)), own).alias("turns"))
    return convs.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("path"),
        F.transform("turns", lambda t: t["size"].cast("int")).alias("sizes"),
    )


def steps(path: str) -> list[str]:
    return [path[i : i + DIGITS] for i in range(0, len(path), DIGITS)]


def find_splitters(convs: DataFrame, rows: int, shards: int) -> list[tuple[str, int]]:
    """At most ``shards - 1`` (path, conv_id), evenly placed among a hashed sample of the sorted rows.

    The driver sees about ``SAMPLES * shards`` sampled paths of ``SPLITTER_TURNS`` turns
    at most. A longer path is cut there; the cut prefix itself becomes the splitter.
    """
    share = min(1.0, SAMPLES * shards / max(rows, 1))
    highest = min(2**63 - 1, int(-(2**63) + share * 2**64))
    picked = convs.where(F.xxhash64("conv_id", F.lit(3)) <= F.lit(highest))
    most = SPLITTER_TURNS * DIGITS
    short = F.length("path") <= most
    sample = picked.select(
        F.substring("path", 1, most).alias("path"), F.when(short, F.col("conv_id")).otherwise(-(2**63)).alias("conv_id")
    )
    found = sorted((r["path"], r["conv_id"]) for r in sample.collect())
    return sorted({found[len(found) * i // shards] for i in range(1, shards)}) if found else []


def skeleton_of(splitters: Iterable[tuple[str, int]]) -> tuple[dict[tuple[int, str], int], list[int]]:
    """(child by node and turn, parent by node) of the trie of the splitters' paths; node 0 is the root."""
    child: dict[tuple[int, str], int] = {}
    parent = [-1]
    for path, _ in splitters:
        at = 0
        for turn in steps(path):
            if (at, turn) not in child:
                child[at, turn] = len(parent)
                parent.append(at)
            at = child[at, turn]
    return child, parent


class Open:
    """A node on the stack: what has been seen of its subtree in this shard."""

    __slots__ = ("skeleton", "depth", "size", "least", "convs", "children", "leaves", "saved", "ends", "chunk", "waiting")

    def __init__(self, skeleton: int, depth: int, size: int):
        self.skeleton, self.depth, self.size = skeleton, depth, size
        self.least: int | None = None
        self.convs = self.children = self.leaves = self.saved = self.chunk = 0
        self.ends = None  # a running hash off the skeleton, ids on it
        self.waiting: list[list] = []


class ShardTrie:
    """Finishes the nodes of one shard from its rows in sorted order, with memory for one path."""

    def __init__(self, shard: int, child: dict[tuple[int, str], int]):
        self.shard, self.child, self.rows = shard, child, []
        self.stack, self.path = [Open(0, 0, 0)], []

    def add(self, conv_id: int, path: list[str], sizes) -> None:
        same, most = 0, min(len(path), len(self.path))
        while same < most and path[same] == self.path[same]:
            same += 1
        while len(self.stack) > same + 1:
            self.close()
        for d in range(same, len(path)):
            above = self.stack[-1].skeleton
            on = self.child.get((above, path[d]), -1) if above >= 0 else -1
            self.stack.append(Open(on, d + 1, int(sizes[d])))
        self.path = path
        top = self.stack[-1]
        top.convs += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        self.end(top, conv_id)

    def end(self, node: Open, conv_id: int) -> None:
        """Notes that a conversation has no turn beyond the node's; they come in ascending order."""
        if node.skeleton < 0:
            if node.ends is None:
                node.ends = hashlib.sha256(str(conv_id).encode())
            else:
                node.ends.update(f",{conv_id}".encode())
            return
        node.ends = node.ends or []
        node.ends.append(str(conv_id))
        if len(node.ends) * 8 > CHUNK:
            self.chunk(node)

    def chunk(self, node: Open) -> None:
        if node.ends:
            self.rows.append(
                ["ends", *[None] * 8, node.skeleton, None, self.shard, node.chunk, ",".join(node.ends)]
            )
            node.chunk, node.ends = node.chunk + 1, []

    def close(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        for row in node.waiting:
            row[3] = node.least
        self.rows += node.waiting
        if above is not None and node.least is not None:
            above.convs += node.convs
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton >= 0:
            self.chunk(node)
            self.rows.append(
                ["part", node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, None,
                 node.skeleton, node.size, self.shard, None, None]
            )
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.convs - 1) * node.size
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        digest = node.ends.hexdigest() if node.ends else NOTHING
        row = ["node", node.least, node.depth, None, node.convs, node.children, leaves, saved, digest,
               above.skeleton, None, None, None, None]
        (self.rows if above.skeleton >= 0 else above.waiting).append(row)

    def finish(self) -> None:
        while self.stack:
            self.close()


def _frame(rows: list[list]) -> pd.DataFrame:
    names = [part.split()[0] for part in NODE.split(", ")]
    kinds = {"string": object, "long": "Int64", "int": "Int32"}
    types = {part.split()[0]: kinds[part.split()[1]] for part in NODE.split(", ")}
    return pd.DataFrame(rows, columns=names, dtype=object).astype(types)


def prefix_nodes(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, with the aggregates of its subtree.

    Repeated rows are turns like any other. A turnless conversation is a member of the
    root alone; an empty table, or one without conv_id, has no node at all. Texts count
    whole, whatever their length; a conversation's digests and sizes must fit in one row
    (about 40 bytes a turn). Extra columns are not read.
    """
    spark = conversations.sparkSession
    convs = written(rebuilt(conversations), "conversation-paths")
    rows = convs.count()
    shards = shards or max(range_count(spark), -(-rows // SHARD_ROWS))
    splitters = find_splitters(convs, rows, shards)
    child, parent = skeleton_of(splitters)
    known = spark.sparkContext.broadcast((splitters, child))

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        cuts = known.value[0]
        return pd.Series([bisect_right(cuts, key) for key in zip(path, conv_id)], dtype="int32")

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie: ShardTrie | None = None
        for frame in frames:
            for shard, conv_id, path, sizes in zip(frame["shard"], frame["conv_id"], frame["path"], frame["sizes"]):
                if trie is None or trie.shard != shard:
                    done = trie.rows if trie else []
                    if trie:
                        trie.finish()
                    trie = ShardTrie(int(shard), known.value[1])
                    trie.rows = done
                trie.add(int(conv_id), steps(path), sizes)
                if len(trie.rows) >= BATCH_ROWS:
                    yield _frame(trie.rows)
                    trie.rows = []
        if trie:
            trie.finish()
            yield _frame(trie.rows)

    dealt = convs.withColumn("shard", shard_of("path", "conv_id")).repartitionById(len(splitters) + 1, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", "path", "conv_id")
    out = written(dealt.mapInPandas(finish, NODE), "prefix-nodes")
    top = skeleton_nodes(spark, out, parent)
    above = top.select(F.col("skeleton"), F.col("conv_id").alias("above"))
    nodes = out.where("kind = 'node'").join(F.broadcast(above), "skeleton", "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return nodes.select(*RESULT).unionByName(top.select(*RESULT))


def skeleton_nodes(spark: SparkSession, out: DataFrame, parent: list[int]) -> DataFrame:
    """The skeleton's finished nodes: partial aggregates reduced by node, then summed from the leaves up.

    There are at most shards times ``SPLITTER_TURNS`` of them, so the driver can hold one
    row for each. Their lists of ids stay in tasks.
    """
    parts = out.where("kind = 'part'").groupBy("skeleton").agg(
        F.min("conv_id").alias("least"), F.max("depth").alias("depth"), F.sum("n_convs").alias("convs"),
        F.sum("n_children").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.max("size").alias("size"),
    )
    found = {r["skeleton"]: r.asDict() for r in parts.collect()}
    # every skeleton node has a member, so parts exist for all of them unless the table is empty
    for k in sorted(found, reverse=True):
        node, above = found[k], found.get(parent[k])
        node["leaves"] = node["leaves"] if node["children"] else 1
        node["saved"] += (node["convs"] - 1) * node["size"]
        if above:
            above["children"] += 1
            above["leaves"] += node["leaves"]
            above["saved"] += node["saved"]
    rows = [
        (k, n["least"], n["depth"], found[parent[k]]["least"] if k else None, n["convs"], n["children"], n["leaves"], n["saved"])
        for k, n in found.items()
    ]
    names = "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    top = spark.createDataFrame(rows, names)
    return top.join(_end_hashes(out), "skeleton", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))
    )


def _end_hashes(out: DataFrame) -> DataFrame:
    """The hash of each skeleton node's list of ids, chunk after chunk in order, one chunk in memory."""
    chunks = out.where("kind = 'ends'").select("skeleton", "shard", "chunk", "ids")
    chunks = chunks.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "chunk")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, digest = None, None
        for frame in frames:
            done = []
            for skeleton, ids in zip(frame["skeleton"], frame["ids"]):
                if skeleton != at:
                    if at is not None:
                        done.append((at, digest.hexdigest()))
                    at, digest = skeleton, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield pd.DataFrame(done, columns=["skeleton", "ends_sha256"]).astype({"skeleton": "int32"})
        if at is not None:
            yield pd.DataFrame([(at, digest.hexdigest())], columns=["skeleton", "ends_sha256"]).astype({"skeleton": "int32"})

    return chunks.mapInPandas(run, "skeleton int, ends_sha256 string")
