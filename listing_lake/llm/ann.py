"""Nearest neighbours by largest inner product, with a vantage-point tree for each shard.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and
queries a zero there. Then |q - x|^2 = |q|^2 + M^2 - 2 <q, x>: the largest inner
product is the smallest distance, and the triangle inequality holds. Shards have
a bounded number of vectors, chosen by a hash of the id; each is built into a
tree once. Queries are put together in blocks; each shard's tree meets every
block as a stream, one block in memory at a time, and yields its own best
``k``; a window keeps the best ``k`` of all shards.

A subtree is skipped if its smallest possible distance, times ``factor``, exceeds
the distance of the k-th best so far. Factor 1, the default, is exact on any
vectors. A larger factor skips more and may miss neighbours, many of them on
vectors with a decaying spectrum or of low rank, so it is for callers that know
their vectors.

Scores are inner products of the given vectors in double precision. Ties go to
the smaller id. Of equal vectors in a shard only the k + 1 with the smallest ids
are kept: no other can be among the k nearest. Vectors that are null, empty, zero
or hold null or non-finite components take no part, nor do null ids. Rows that
share an id count as one, with the smallest of their vectors. Only vectors of
the same length are compared. Empty tables: no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.session import stored

K = 20
EVERY = 20
FACTOR = 1.0
SHARD = 4096
BLOCK = 512
LEAF = 128


# ---------------------------------------------------------------- one tree


@dataclass
class Node:
    members: np.ndarray | None = None  # of a leaf
    vantage: int = -1
    reach: float = 0.0  # largest distance of the inner part
    gap: float = 0.0  # smallest distance of the outer part
    inner: Node | None = None
    outer: Node | None = None


@dataclass
class Tree:
    ids: np.ndarray
    vectors: np.ndarray  # with the added coordinate last
    top: float  # the largest norm
    root: Node


def build(ids: np.ndarray, vectors: np.ndarray, top: float, keep: int = K + 1) -> Tree:
    order = np.argsort(ids)
    ids, vectors = ids[order], vectors[order]
    _, group = np.unique(vectors, axis=0, return_inverse=True)
    by = np.argsort(group.ravel(), kind="stable")  # ids stay in order within equal vectors
    first = np.searchsorted(group.ravel()[by], group.ravel()[by], "left")
    kept = np.sort(by[np.arange(len(by)) - first < keep])
    ids, vectors = ids[kept], vectors[kept]
    rest = np.sqrt(np.maximum(0.0, top * top - (vectors * vectors).sum(axis=1)))
    points = np.column_stack([vectors, rest])

    def split(members: np.ndarray) -> Node:
        if len(members) <= LEAF:
            return Node(members)
        # the member farthest from the middle sees the others at different distances
        middle = points[members].mean(axis=0)
        far = int(np.argmax(((points[members] - middle) ** 2).sum(axis=1)))
        vantage, others = int(members[far]), np.delete(members, far)
        away = np.sqrt(((points[others] - points[vantage]) ** 2).sum(axis=1))
        by = np.argsort(away, kind="stable")
        half = len(by) // 2
        return Node(
            vantage=vantage,
            reach=float(away[by[half - 1]]),
            gap=float(away[by[half]]),
            inner=split(others[by[:half]]),
            outer=split(others[by[half:]]),
        )

    return Tree(ids, points, top, split(np.arange(len(ids))))


class Search:
    """A block of queries on its way through one tree.

    Block products may differ from the scores in their last bits, so they only
    choose candidates, with a slack; what is kept and cut is ordered by exact
    scores and, where those are equal, by id.
    """

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.tree, self.ids, self.factor, self.k = tree, ids, factor, k
        self.queries, self.vectors = queries, np.ascontiguousarray(tree.vectors[:, :-1])
        self.squares = (queries * queries).sum(axis=1) + tree.top * tree.top
        # the rounding of a product, and of a distance that is the root of a small difference
        self.score_slack, self.slack = 1e-12 * self.squares, 1e-7 * np.sqrt(self.squares)
        self.best = np.full((len(ids), k), -np.inf)
        self.who = np.full((len(ids), k), -1)  # places in the tree, which are in the order of ids
        self.compared = 0
        self.visit(tree.root, np.arange(len(ids)))

    def bound(self, rows: np.ndarray) -> np.ndarray:
        """Distance of the k-th best."""
        kth = self.best[rows, self.k - 1]
        return np.sqrt(np.maximum(0.0, self.squares[rows] - 2 * kth))

    def meet(self, rows: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Takes members as candidates; returns their inner products."""
        products = self.queries[rows] @ self.vectors[members].T
        self.compared += products.size
        near = products >= (self.best[rows, -1] - self.score_slack[rows])[:, None]
        near &= self.tree.ids[members] != self.ids[rows, None]
        row, place = np.nonzero(near)
        who = members[place]
        exact = (self.queries[rows[row]] * self.vectors[who]).sum(axis=1)
        order = np.lexsort((who, -exact, row))
        row, who, exact = row[order], who[order], exact[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row, "left")
        first = nth < self.k
        hit, at = np.unique(row, return_inverse=True)
        scores, names = np.full((len(hit), self.k), -np.inf), np.full((len(hit), self.k), -1)
        scores[at[first], nth[first]], names[at[first], nth[first]] = exact[first], who[first]
        scores = np.concatenate([self.best[rows[hit]], scores], axis=1)
        names = np.concatenate([self.who[rows[hit]], names], axis=1)
        by = np.lexsort((names, -scores), axis=1)[:, : self.k]
        self.best[rows[hit]] = np.take_along_axis(scores, by, 1)
        self.who[rows[hit]] = np.take_along_axis(names, by, 1)
        return products

    def visit(self, node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.members is not None:
            self.meet(rows, node.members)
            return
        product = self.meet(rows, np.array([node.vantage]))[:, 0]
        away = np.sqrt(np.maximum(0.0, self.squares[rows] - 2 * product))
        within = away <= node.reach
        self.visit(node.inner, rows[within])
        self.visit(node.outer, rows[~within])
        slack = self.slack[rows]
        outer = within & (self.factor * (node.gap - away - slack) <= self.bound(rows) + slack)
        inner = ~within & (self.factor * (away - node.reach - slack) <= self.bound(rows) + slack)
        self.visit(node.outer, rows[outer])
        self.visit(node.inner, rows[inner])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, vector id, score) of at most k for each query, best first."""
        row, place = np.nonzero(self.who >= 0)
        return self.ids[row], self.tree.ids[self.who[row, place]], self.best[row, place]


# ---------------------------------------------------------------- shards and blocks


def _usable(vectors: DataFrame) -> DataFrame:
    each = F.col("embedding")
    parts = F.transform(each, lambda x: x.cast("double"))
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & each.isNotNull())
        .filter(finite & F.exists(each, lambda x: x != 0.0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding"))
    )


def _gathered(kind: int, top: dict[int, float] | None, k: int):
    """One row with all vectors of a group: a tree (kind 0) or a block of queries (kind 1)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        ids, dim = table.column("vec_id").to_numpy(), table.column("dim")[0].as_py()
        vectors = table.column("embedding").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
        content = build(ids, vectors, top[dim], k + 1) if kind == 0 else (ids, vectors)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([dim], pa.int32()),
                pa.array([table.column("part")[0].as_py()], pa.int32()),
                pa.array([kind], pa.int32()),
                pa.array([pickle.dumps(content)], pa.binary()),
            ],
            ["dim", "part", "kind", "content"],
        )

    return gather


_PARTS = "dim int, part int, kind int, content binary"


def _meet(k: int, factor: float):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None  # rows are sorted: each shard's tree comes before its blocks
        for batch in batches:
            for kind, content in zip(batch.column("kind").to_pylist(), batch.column("content")):
                found = pickle.loads(content.as_buffer())
                if kind == 0:
                    tree = found
                    continue
                query, vec, score = Search(tree, *found, k, factor).result()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"]
                )

    return meet


def nearest(
    vectors: DataFrame, k: int = K, every: int = EVERY, factor: float = FACTOR, shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest to each vector whose id every divides.

    vectors: (vec_id, embedding).
    """
    rows = stored(_usable(vectors))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    asked = F.col("vec_id") % every == 0
    facts = rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if(asked).alias("asked"), F.sqrt(F.max(square)).alias("top")
    )
    facts = facts.collect()  # one row for each length of vector
    if not facts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def parts(count: str, size: int):
        found = F.lit(1)
        for f in facts:
            found = F.when(F.col("dim") == f["dim"], ceil(f[count] / size) or 1).otherwise(found)
        return found

    def part(count: str, size: int, seed: str):
        return F.pmod(F.xxhash64(F.lit(seed), "vec_id"), parts(count, size)).cast("int").alias("part")

    trees = rows.select("*", part("n", shard, "shard")).groupBy("dim", "part").applyInArrow(
        _gathered(0, {f["dim"]: f["top"] for f in facts}, k), _PARTS
    )
    blocks = rows.filter(asked).select("*", part("asked", block, "block")).groupBy("dim", "part").applyInArrow(
        _gathered(1, None, k), _PARTS
    )
    shards = [ceil(f["n"] / shard) for f in facts]
    task = F.lit(0)  # a task for each shard, numbered over all lengths; a hash would put several into one
    for number, f in enumerate(facts):
        task = F.when(F.col("dim") == f["dim"], F.col("part") + sum(shards[:number])).otherwise(task)
    tasks = min(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(shards))
    everywhere = stored(blocks).select(
        "dim", F.explode(F.sequence(F.lit(0), parts("n", shard) - 1)).alias("part"), "kind", "content"
    )
    met = (
        stored(trees).union(everywhere)
        .repartitionById(tasks, task.cast("int"))
        .sortWithinPartitions("dim", "part", "kind")
        .mapInArrow(_meet(k, factor), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
