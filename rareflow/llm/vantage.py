"""Nearest neighbours by largest inner product, from a vantage-point tree in every shard.

Every vector is in one shard, dealt by a hash, and every shard has a tree of its own.
Inside a shard a further coordinate makes all vectors equally long, so that the largest
inner product is the least distance and the triangle inequality holds. A subtree is
passed over if ``factor`` times the least distance that the inequality allows its vectors
exceeds the distance of the query's k-th neighbour so far. Factor one is exact; larger
factors pass over more. Queries go through the shards in blocks and in waves of doubling
size, one shard first: each wave starts from the neighbours of the ones before, so a
later shard hands back few candidates, about k for each wave.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareflow.llm.common import written

#: Vectors of a shard, vectors of a leaf, queries that meet a shard in one task, vantage points tried for a node.
SHARD_ROWS, LEAF_ROWS, BLOCK_ROWS, TRIED = 8192, 256, 1024, 4
#: One is exact. Larger factors save work on clustered vectors at the price of recall.
FACTOR = 1.0
HITS = "row long, query_id long, vec_id long, other long, score double"


@dataclass
class Tree:
    """Points in leaf order; a node has a vantage point, the range of distances on either side, two children.

    Points are divided by two to the ``power``, so that no component exceeds one and no
    square overflows. A child is a node's number, or -1 minus a leaf's number.
    """

    points: np.ndarray
    power: int
    order: np.ndarray
    longest: float
    extra: np.ndarray
    vantage: np.ndarray
    ranges: np.ndarray
    children: np.ndarray
    leaves: np.ndarray


def powers(rows: np.ndarray) -> np.ndarray:
    """For each row the least power of two that no component exceeds."""
    return np.frexp(np.abs(rows).max(axis=1))[1]


def build_tree(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Halves the points again and again by their distance from a vantage point among them.

    Ties are halved by position, so that equal vectors make no deep branch.
    """
    rng = np.random.default_rng(len(points))
    power = int(powers(points).max())
    points = np.ldexp(points, -power)
    squares = np.einsum("ij,ij->i", points, points)
    longest = float(squares.max())
    extra = np.sqrt(np.maximum(longest - squares, 0.0))
    order: list[np.ndarray] = []
    vantage, ranges, children, leaves = [], [], [], []

    def distances(a: int, rows: np.ndarray) -> np.ndarray:
        square = 2 * longest - 2 * (points[rows] @ points[a] + extra[rows] * extra[a])
        return np.sqrt(np.maximum(square, 0.0))

    def grow(rows: np.ndarray) -> int:
        if len(rows) <= leaf_rows:
            at = sum(map(len, order))
            order.append(rows)
            leaves.append((at, at + len(rows)))
            return -len(leaves)
        some = rng.choice(rows, TRIED)
        spread = [distances(a, rows[:: max(1, len(rows) // 256)]).std() for a in some]
        a = int(some[int(np.argmax(spread))])
        d = distances(a, rows)
        by = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = by[:half], by[half:]
        node = len(vantage)
        vantage.append(a)
        ranges.append((d[near[0]], d[near[-1]], d[far[0]], d[far[-1]]))
        children.append((0, 0))
        children[node] = (grow(rows[near]), grow(rows[far]))
        return node

    grow(np.arange(len(points)))
    placed = np.concatenate(order)
    at = np.empty(len(points), np.int64)
    at[placed] = np.arange(len(points))
    return Tree(
        points[placed], power, placed, longest, extra[placed], at[np.array(vantage, np.int64)],
        np.array(ranges, float).reshape(-1, 4), np.array(children, np.int64).reshape(-1, 2),
        np.array(leaves, np.int64).reshape(-1, 2),
    )


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def least_distances(tree: Tree, queries: np.ndarray) -> np.ndarray:
    """What the triangle inequality allows: the least distance from each query to each leaf's points."""
    squares = np.einsum("ij,ij->i", queries, queries)
    away = squares[:, None] + tree.longest - 2 * queries @ tree.points[tree.vantage].T
    away = np.sqrt(np.maximum(away, 0.0))
    bounds = np.zeros((len(queries), len(tree.leaves)))
    todo = [(0, np.zeros(len(queries)))] if len(tree.vantage) else []
    while todo:
        node, above = todo.pop()
        d = away[:, node]
        for side in (0, 1):
            low, high = tree.ranges[node, 2 * side : 2 * side + 2]
            bound = np.maximum(above, np.maximum(low - d, d - high))
            child = int(tree.children[node, side])
            if child >= 0:
                todo.append((child, bound))
            else:
                bounds[:, -child - 1] = bound
    return bounds


def search_tree(
    tree: Tree, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, factor: float
) -> tuple[np.ndarray, np.ndarray, int]:
    """(query number, point's place) of all that may be among the k nearest, and the products worked out.

    ``own`` is the place of the query itself or -1; ``floor`` the k-th best product that
    other shards have, with the tree's divided points. No component of a query exceeds
    one. Each query scans the leaf of least bound first.
    """
    n = len(queries)
    scale = np.sqrt(np.einsum("ij,ij->i", queries, queries)) * np.sqrt(tree.longest)
    slack = 1e-9 * scale
    reach = np.sqrt(np.einsum("ij,ij->i", queries, queries)) + np.sqrt(tree.longest)
    bounds = least_distances(tree, queries)
    best = np.full((n, k), -np.inf)
    kth = floor.copy()
    first = bounds.argmin(axis=1)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    work = 0
    squares = np.einsum("ij,ij->i", queries, queries)

    def scan(leaf: int, rows: np.ndarray) -> None:
        nonlocal work
        a, b = tree.leaves[leaf]
        work += len(rows) * (b - a)
        products = queries[rows] @ tree.points[a:b].T
        mine = np.flatnonzero((own[rows] >= a) & (own[rows] < b))
        products[mine, own[rows[mine]] - a] = -np.inf
        near = np.flatnonzero(products.max(axis=1) >= kth[rows] - slack[rows])
        rows, products = rows[near], products[near]
        both = np.concatenate([best[rows], products], axis=1)
        best[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        kth[rows] = np.maximum(floor[rows], best[rows].min(axis=1))
        q, p = np.nonzero((products >= (kth[rows] - slack[rows])[:, None]) & (products > -np.inf))
        found.append((rows[q], p + a, products[q, p]))

    for leaf in range(len(tree.leaves)):
        rows = np.flatnonzero(first == leaf)
        if len(rows):
            scan(leaf, rows)
    for leaf in np.argsort(bounds.mean(axis=0), kind="stable"):
        radius = np.sqrt(np.maximum(squares + tree.longest - 2 * kth, 0.0)) + 1e-6 * reach
        rows = np.flatnonzero((first != leaf) & (factor * bounds[:, leaf] <= radius))
        if len(rows):
            scan(int(leaf), rows)
    q, p, s = (np.concatenate(part) for part in zip(*found))
    keep = s >= kth[q] - slack[q]
    return q[keep], p[keep], work


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, vector, dim) of the vectors that take part, each row with a key of its own."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & vector.isNotNull()).where(fine & F.exists(vector, lambda x: x != 0.0))
    return rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        vector.alias("vector"), F.size(vector).alias("dim"),
    )


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """One row for each shard: its points in leaf order and its tree."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(frame["vector"].to_numpy())
        tree = build_tree(vectors)
        return pd.DataFrame(
            {
                "dim": frame["dim"].iloc[:1], "shard": frame["shard"].iloc[:1],
                "rows": [frame["row"].to_numpy()[tree.order]], "ids": [frame["vec_id"].to_numpy()[tree.order]],
                "points": [vectors[tree.order].tobytes()], "power": [tree.power], "longest": [tree.longest], "extra": [tree.extra.tobytes()],
                "vantage": [tree.vantage], "ranges": [tree.ranges.ravel()], "children": [tree.children.ravel()],
                "leaves": [tree.leaves.ravel()],
            }
        )

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInPandas(
        build,
        "dim int, shard int, rows array<long>, ids array<long>, points binary, power int, longest double, extra binary, "
        "vantage array<long>, ranges array<double>, children array<long>, leaves array<long>",
    )


def _search(k: int, factor: float):
    """Searches one shard for one block of queries; gives the k best of each by exact product."""

    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(index):
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "other": [], "score": []})
        x = index.iloc[0]
        points = np.frombuffer(x["points"]).reshape(len(x["rows"]), -1)
        power = int(x["power"])
        tree = Tree(
            np.ldexp(points, -power), power, np.arange(len(points)), float(x["longest"]), np.frombuffer(x["extra"]), np.asarray(x["vantage"], np.int64),
            np.asarray(x["ranges"], float).reshape(-1, 4), np.asarray(x["children"], np.int64).reshape(-1, 2),
            np.asarray(x["leaves"], np.int64).reshape(-1, 2),
        )
        rows, ids = np.asarray(x["rows"]), np.asarray(x["ids"])
        place = pd.Series(np.arange(len(rows)), index=rows)
        own = place.reindex(queries["row"]).fillna(-1).to_numpy(np.int64)
        matrix = np.stack(queries["vector"].to_numpy())
        size = powers(matrix)
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            floor = np.ldexp(queries["kth"].fillna(-np.inf).to_numpy(float), -(size + power))
            q, p, _ = search_tree(tree, np.ldexp(matrix, -size[:, None]), own, floor, k, factor)
            score = exact_products(matrix[q], points[p])
        by = np.lexsort((rows[p], ids[p], -score, q))
        q, p, score = q[by], p[by], score[by]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        q, p, score = q[rank < k], p[rank < k], score[rank < k]
        return pd.DataFrame(
            {
                "row": queries["row"].to_numpy()[q], "query_id": queries["vec_id"].to_numpy()[q],
                "vec_id": ids[p], "other": rows[p], "score": score,
            }
        )

    return run


def nearest(
    df: DataFrame, k: int = 20, factor: float = FACTOR, every: int = 20, id_col: str = "vec_id",
    vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its k nearest.

    Ties go to the smaller vec_id. Rows without an id, and vectors that are null, empty,
    zero or hold a null or a non-finite component, take no part. Vectors are compared
    with those of equal length only. Rows are told apart by themselves, so rows that
    repeat an id or a vector are candidates of one another and each gets its own list.
    An empty table gives no rows; extra columns are not read.
    """
    spark = df.sparkSession
    vectors = written(usable(df, id_col, vector_col), "vectors")
    queries = vectors.where(F.col("vec_id") % every == 0)
    total, asked = vectors.count(), queries.count()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // block_rows))
    index = written(build_index(vectors, shards), "vantage-trees")
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(blocks)).cast("int"))
    hits = spark.createDataFrame([], HITS)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "other")
    begun, width = 0, 1
    while begun < shards:
        end = min(shards, begun + width)
        kth = hits.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
        left = queries.join(kth.drop("n"), "row", "left")
        left = left.withColumn("shard", F.explode(F.sequence(F.lit(begun), F.lit(end - 1))))
        right = index.where(F.col("shard").between(begun, end - 1))
        right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keys = ["dim", "shard", "block"]
        more = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(k, factor), HITS)
        hits = hits.unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        hits = written(hits.drop("rank"), "neighbours")
        begun, width = end, end
    return hits.withColumn("rank", F.row_number().over(best)).select("query_id", "rank", "vec_id", "score")
