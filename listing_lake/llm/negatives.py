"""Hard negatives by window search in multiway hyperplane trees.

Components become integers (see ``codes.integers``), scores are inner products. An
anchor's positives are its best rows of the same label; a hard negative of a
positive has another label and a score inside a window below the positive's.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and
anchors a zero there: then |q - x|^2 = |q|^2 + M^2 - 2 <q, x>, and a window of scores
is an annulus around the anchor. A node of a tree has up to ``WAYS`` split points far
from each other; each of its vectors belongs to the nearest one, so that
hyperplanes part the subtrees. For every split point i and subtree j the node has
the smallest and largest distance from i to the vectors of j. With the distances D
from an anchor to the split points, a vector of j is at least
max(D_i - largest, smallest - D_i) and at most D_i + largest away, for every i: j is
left out if that range misses the annulus. The nearest subtree is visited first, and
an annulus shrinks with the worst row found so far. Leaves are compared in full, so
results are exact: scores are whole numbers, ties go to the smaller id, and the
slack of the distances is far above their rounding.

The same rule works between machines. The topmost node is made from a bounded
sample (``SAMPLE`` rows) and deals all vectors out to cells; large cells are cut by a
hash of the id into shards of about ``SHARD`` vectors, each with a tree. Anchors go
only to the shards of cells that their annuli meet; the search for positives first
asks the anchor's own shard, whose answer bounds the rest. A shard meets its
anchors as a stream.

Null ids and labels, and vectors that are null or hold null or non-finite
components, take no part. Rows that share an id count as one, with the smallest
label and vector. Only vectors of the same length are compared. Without positives or
negatives an anchor has no rows. Integers are held within 2 ** 20 (less for vectors
of more than 256 components), so that scores stay exact. Other columns are ignored.
Empty tables: no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.llm import codes
from listing_lake.llm.common import bounded, slices
from listing_lake.session import stored

EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: The window in hundredths of the positive's score.
LOW, HIGH = 50, 95
WAYS, LEAF = 8, 128
SHARD = 4096
#: Cells of the topmost node, and rows that it is made from.
CELLS, SAMPLE = 64, 4096
#: Anchors that are searched together.
BLOCK = 512

_NONE = np.iinfo(np.int64).min


# ---------------------------------------------------------------- split points


def far_apart(points: np.ndarray, ways: int) -> np.ndarray:
    """Indexes of up to ``ways`` different points, each the farthest from those before."""
    chosen = [int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    nearest = _away(points, points[chosen[0]])
    while len(chosen) < ways and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _away(points, points[chosen[-1]]))
    return np.array(chosen)


def _away(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - one) ** 2).sum(axis=1))


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """With the added coordinate; top is the square of the largest norm."""
    rest = np.sqrt(np.maximum(0.0, top - (vectors * vectors).sum(axis=1)))
    return np.column_stack([vectors, rest])


@dataclass
class Ranges:
    """Distances from split point i to the vectors of subtree j, at [i, j]."""

    least: np.ndarray
    most: np.ndarray

    @classmethod
    def of(cls, away: np.ndarray, nearest: np.ndarray) -> Ranges:
        """away: vectors x split points; nearest: the subtree of each vector."""
        ways = away.shape[1]
        least, most = np.full((ways, ways), np.inf), np.full((ways, ways), -np.inf)
        for j in np.unique(nearest):
            own = away[nearest == j]
            least[:, j], most[:, j] = own.min(axis=0), own.max(axis=0)
        return cls(least, most)

    def bounds(self, away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest distance from each query to a vector of each subtree."""
        d = away[:, :, None]
        return (
            np.maximum(np.maximum(d - self.most, self.least - d).max(axis=1), 0.0),
            (d + self.most).min(axis=1),
        )


def _radius(squares: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, squares[:, None] - 2 * scores))


def _meets(least, most, inner, outer, slack: float) -> np.ndarray:
    """Whether any annulus of a query meets the range of distances."""
    return ((least[:, None] <= outer + slack) & (most[:, None] >= inner - slack)).any(axis=1)


# ---------------------------------------------------------------- one tree


@dataclass
class Node:
    members: np.ndarray  # of a leaf, or the split points
    ranges: Ranges | None = None
    children: list | None = None  # None for a subtree without vectors


@dataclass
class Tree:
    ids: np.ndarray  # ascending
    labels: np.ndarray
    vectors: np.ndarray
    top: float  # the square of the largest norm
    root: Node


def build(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, top: float) -> Tree:
    order = np.argsort(ids)
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    points = lifted(vectors, top)

    def split(members: np.ndarray) -> Node:
        if len(members) <= LEAF:
            return Node(members)
        some = members[:: max(1, len(members) // 256)]
        chosen = some[far_apart(points[some], WAYS)]
        if len(chosen) < 2 and not _away(points[members], points[chosen[0]]).any():
            return Node(members)  # equal vectors cannot be told apart
        rest = np.setdiff1d(members, chosen)
        away = np.stack([_away(points[rest], points[c]) for c in chosen], axis=1)
        nearest = away.argmin(axis=1)
        own = [rest[nearest == j] for j in range(len(chosen))]
        return Node(chosen, Ranges.of(away, nearest), [split(m) if len(m) else None for m in own])

    return Tree(ids, labels, vectors, top, split(np.arange(len(ids))))


class Search:
    """A block of anchors with windows of scores on its way through one tree.

    low, high: anchors x windows. same: whether rows of the anchor's own label are
    sought, or of any other.
    """

    def __init__(self, tree: Tree, ids, labels, vectors, low, high, k: int, same: bool):
        self.tree, self.ids, self.labels, self.vectors = tree, ids, labels, vectors
        self.low, self.high, self.k, self.same = low, high, k, same
        self.squares = (vectors * vectors).sum(axis=1) + tree.top
        self.slack = 1e-9 * (1 + tree.top**0.5)
        # score and place in one number: of equal scores the smaller id is the larger number
        self.bits = max(1, int(len(tree.ids)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.best = np.full((*low.shape, k), _NONE)
        self.inner = _radius(self.squares, high)
        self.compared = 0
        self.visit(tree.root, np.arange(len(ids)))

    def offer(self, rows: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Takes members as candidates; returns their scores."""
        scores = self.vectors[rows] @ self.tree.vectors[members].T
        self.compared += scores.size
        low, high = self.lowest(rows), self.high[rows]
        # few are inside any window, the more so as the windows shrink
        near = (scores >= low.min(axis=1)[:, None]) & (scores <= high.max(axis=1)[:, None])
        near &= (self.tree.labels[members] == self.labels[rows, None]) == self.same
        row, place = np.nonzero(near)
        if self.same:
            other = self.tree.ids[members[place]] != self.ids[rows[row]]
            row, place = row[other], place[other]
        score = scores[row, place]
        keys = (score.astype(np.int64) << self.bits) | (self.mask - members[place])
        order = np.lexsort((-keys, row))
        row, score, keys = row[order], score[order], keys[order]
        for w in range(low.shape[1]):
            inside = (score >= low[row, w]) & (score <= high[row, w])
            own, found = row[inside], keys[inside]
            nth = np.arange(len(own)) - np.searchsorted(own, own, "left")
            first = nth < self.k
            hit = np.unique(own)
            fresh = np.full((len(hit), self.k), _NONE)
            fresh[np.searchsorted(hit, own[first]), nth[first]] = found[first]
            both = np.concatenate([self.best[rows[hit], w], fresh], axis=1)
            self.best[rows[hit], w] = np.sort(both, axis=1)[:, : -self.k - 1 : -1]
        return scores

    def lowest(self, rows: np.ndarray) -> np.ndarray:
        """The low ends of the windows, as raised by what has been found."""
        worst = self.best[rows, :, -1]
        return np.where(worst == _NONE, self.low[rows], np.maximum(self.low[rows], worst >> self.bits))

    def visit(self, node: Node, rows: np.ndarray) -> None:
        scores = self.offer(rows, node.members)
        if node.children is None:
            return
        away = np.sqrt(np.maximum(0.0, self.squares[rows, None] - 2 * scores))
        least, most = node.ranges.bounds(away)
        nearest = away.argmin(axis=1)
        # each anchor's nearest subtree first, then the others, which its answer may rule out
        for own in (True, False):
            for j, child in enumerate(node.children):
                at = np.flatnonzero((nearest == j) == own)
                if child is None or not len(at):
                    continue
                sought = rows[at]
                outer = _radius(self.squares[sought], self.lowest(sought))
                at = at[_meets(least[at, j], most[at, j], self.inner[sought], outer, self.slack)]
                if len(at):
                    self.visit(child, rows[at])

    def result(self) -> tuple[np.ndarray, ...]:
        """(place of the anchor, window, vector id, score) of what was found."""
        row, window, nth = np.nonzero(self.best != _NONE)
        keys = self.best[row, window, nth]
        return row, window, self.tree.ids[self.mask - (keys & self.mask)], keys >> self.bits


# ---------------------------------------------------------------- the topmost node


@dataclass
class Top:
    """For one length of vector: split points, ranges, and the shards of each cell."""

    square: float
    points: np.ndarray
    ranges: Ranges | None = None
    first: list[int] | None = None  # the first shard of each cell, numbered over all lengths
    parts: list[int] | None = None  # how many it has

    def shards(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray | None):
        """For each anchor the shards that its windows meet, less its own one."""
        squares = (vectors * vectors).sum(axis=1) + self.square
        scores = vectors @ self.points[:, :-1].T
        away = np.sqrt(np.maximum(0.0, squares[:, None] - 2 * scores))
        least, most = self.ranges.bounds(away)
        inner, outer = _radius(squares, high), _radius(squares, low)
        slack = 1e-9 * (1 + self.square**0.5)
        meets = np.stack(
            [_meets(least[:, j], most[:, j], inner, outer, slack) for j in range(len(self.points))], axis=1
        )
        cells = [np.arange(f, f + n) for f, n in zip(self.first, self.parts)]
        for i, row in enumerate(meets):
            found = np.concatenate([cells[j] for j in np.flatnonzero(row)] or [np.empty(0, np.int64)])
            yield found if own is None else found[found != own[i]]


def _vectors(rows: pa.RecordBatch, dim: int, name: str = "vector") -> np.ndarray:
    return rows.column(name).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows.num_rows, dim)


def _by_dim(rows: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    for dim in rows.column("dim").unique().to_pylist():
        yield dim, rows.filter(pa.compute.equal(rows.column("dim"), dim))


def _cells(tops: dict[int, Top]):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 * BLOCK):
            for dim, rows in _by_dim(batch):
                points = lifted(_vectors(rows, dim), tops[dim].square)
                away = np.stack([_away(points, p) for p in tops[dim].points], axis=1)
                cell = away.argmin(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(cell), pa.array(list(away), pa.list_(pa.float64()))],
                    [*rows.schema.names, "cell", "away"],
                )

    return cells


def _tops(rows: DataFrame, shard: int, cells: int, sample: int) -> dict[int, Top]:
    facts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max("square").alias("square")).collect()
    tops = {}
    for dim, n, square in facts:  # one row for each length of vector
        some = bounded(rows.filter(F.col("dim") == dim).select("vec_id", "vector"), sample, "vec_id").collect()
        if not some:  # a sample by hash may be empty
            some = rows.filter(F.col("dim") == dim).select("vec_id", "vector").limit(1).collect()
        points = lifted(np.array([r["vector"] for r in some], float).reshape(len(some), dim), square)
        tops[dim] = Top(square, points[far_apart(points, min(cells, ceil(n / shard)))])
    return tops


def _ranged(celled: DataFrame, tops: dict[int, Top], shard: int) -> None:
    """Completes the tops by the ranges and sizes of the cells."""
    for top in tops.values():
        ways = len(top.points)
        top.ranges = Ranges(np.full((ways, ways), np.inf), np.full((ways, ways), -np.inf))
        top.first, top.parts = [], [0] * ways
    spread = celled.select("dim", "cell", F.posexplode("away").alias("point", "away")).groupBy("dim", "cell", "point")
    found = spread.agg(F.min("away").alias("least"), F.max("away").alias("most"), F.count("*").alias("n"))
    for dim, cell, point, least, most, n in found.collect():  # at most CELLS ** 2 rows for each length
        tops[dim].ranges.least[point, cell], tops[dim].ranges.most[point, cell] = least, most
        tops[dim].parts[cell] = ceil(n / shard)
    before = 0
    for top in tops.values():
        top.first = (before + np.cumsum(top.parts) - top.parts).tolist()
        before += sum(top.parts)


def _shard_of(tops: dict[int, Top]) -> Column:
    """The shard of a row by its cell and a hash of its id."""
    found = F.lit(0)
    for dim, top in tops.items():
        first, parts = (F.array(*map(F.lit, x))[F.col("cell")] for x in (top.first, top.parts))
        found = F.when(F.col("dim") == dim, first + F.pmod(F.xxhash64("vec_id"), parts)).otherwise(found)
    return found.cast("int")


# ---------------------------------------------------------------- shards meet anchors

_TREE = "dim int, shard int, content binary"


def _trees(tops: dict[int, Top]):
    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks().to_batches()[0]
        dim = rows.column("dim")[0].as_py()
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        tree = build(ids, labels, _vectors(rows, dim), tops[dim].square)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([dim], pa.int32()),
                pa.array([rows.column("shard")[0].as_py()], pa.int32()),
                pa.array([pickle.dumps(tree)], pa.binary()),
            ],
            ["dim", "shard", "content"],
        )

    return trees


def _routes(tops: dict[int, Top], windows: int, elsewhere: bool):
    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK):
            for dim, rows in _by_dim(batch):
                low, high = _vectors(rows, windows, "low"), _vectors(rows, windows, "high")
                own = rows.column("shard").to_numpy() if elsewhere else None
                found = list(tops[dim].shards(_vectors(rows, dim), low, high, own))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(n) for n in _ASKED), pa.array(found, pa.list_(pa.int32()))], [*_ASKED, "shards"]
                )

    return routes


_ASKED = ("vec_id", "label", "vector", "dim", "low", "high")
_ASKED_TYPES = "vec_id long, label long, vector array<double>, dim int, low array<double>, high array<double>"
_MET = "anchor_id long, window int, vec_id long, score long"


def _meet(k: int, windows: int, same: bool):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None  # rows are sorted: the tree of a shard comes before its anchors
        for batch in batches:
            is_tree = batch.column("content").is_valid().to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                if is_tree[at]:
                    tree, at = pickle.loads(batch.column("content")[at].as_buffer()), at + 1
                    continue
                more = np.flatnonzero(is_tree[at : at + BLOCK])
                end = min(batch.num_rows, at + (int(more[0]) if len(more) else BLOCK))
                rows = batch.slice(at, end - at)
                at = end
                ids = rows.column("vec_id").to_numpy()
                row, window, vec, score = Search(
                    tree,
                    ids,
                    rows.column("label").to_numpy(),
                    _vectors(rows, tree.vectors.shape[1]),
                    _vectors(rows, windows, "low"),
                    _vectors(rows, windows, "high"),
                    k,
                    same,
                ).result()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(window.astype(np.int32)), pa.array(vec), pa.array(score)],
                    ["anchor_id", "window", "vec_id", "score"],
                )

    return meet


def _search(trees: DataFrame, asked: DataFrame, tasks: int, k: int, windows: int, same: bool) -> DataFrame:
    """What each shard finds for the anchors that were sent to it (asked, with shard)."""
    return (
        trees.unionByName(asked, allowMissingColumns=True)
        .repartitionById(tasks, "shard")  # a hash would put several shards into one task
        .sortWithinPartitions("shard", F.desc_nulls_last("content"))
        .select("vec_id", "label", "vector", "low", "high", "content")
        .mapInArrow(_meet(k, windows, same), _MET)
    )


def _best(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def labelled(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector, dim, square) of the rows that take part."""
    size = F.greatest(F.size("embedding"), F.lit(256))
    limit = F.floor(F.sqrt(F.lit(2.0**48) / size))  # of the integers, 2 ** 20 up to 256 components
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        codes.integers(F.col("embedding"), limit=limit).alias("vector"),
    ).dropna()
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return one.withColumns({"dim": F.size("vector"), "square": square})


def mine(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    shard: int = SHARD,
    cells: int = CELLS,
    sample: int = SAMPLE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    vectors: (vec_id, label, embedding). Anchors are the rows whose id ``every`` divides.
    """
    if shard > SHARD:
        raise ValueError(f"score and place share 64 bits: shards of at most {SHARD} vectors")
    spark = vectors.sparkSession
    rows = stored(labelled(vectors))
    tops = _tops(rows, shard, cells, sample)
    if not tops:
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        )
    celled = stored(
        rows.drop("square").mapInArrow(
            _cells(tops), "vec_id long, label long, vector array<double>, dim int, cell int, away array<double>"
        )
    )
    _ranged(celled, tops, shard)
    placed = celled.select("vec_id", "label", "vector", "dim", _shard_of(tops).alias("shard"))
    # a task for each shard, up to some for each shuffle partition
    tasks = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), sum(sum(t.parts) for t in tops.values()))
    trees = stored(placed.groupBy("dim", "shard").applyInArrow(_trees(tops), _TREE))
    anchors = stored(placed.filter(F.col("vec_id") % every == 0))

    def routed(asked: DataFrame, windows: int, elsewhere: bool) -> DataFrame:
        ways = asked.mapInArrow(_routes(tops, windows, elsewhere), f"{_ASKED_TYPES}, shards array<int>")
        return ways.withColumn("shard", F.explode("shards")).drop("shards")

    everything = {"low": F.array(F.lit(float("-inf"))), "high": F.array(F.lit(float("inf")))}
    at_home = stored(_search(trees, anchors.withColumns(everything), tasks, positives, 1, True))
    # what the own shard has bounds the search in the others
    worst = at_home.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    bound = F.when(F.col("n") == positives, F.col("worst").cast("double")).otherwise(F.lit(float("-inf")))
    asked = anchors.join(worst, "vec_id", "left").withColumns({"low": F.array(bound), "high": everything["high"]})
    others = _search(
        trees, routed(asked.select(*_ASKED, "shard"), 1, True), tasks, positives, 1, True
    )
    pairs = stored(
        _best(at_home.unionByName(others), positives, "anchor_id").select(
            "anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
    )
    # in whole numbers: low * p <= 100 * n <= high * p
    p = F.col("positive_score")
    pairs_with = pairs.withColumns(
        {
            "low": (-F.floor((-low * p).cast("decimal(38,0)") / 100)).cast("double"),
            "high": F.floor((high * p).cast("decimal(38,0)") / 100).cast("double"),
        }
    )
    empty = F.sequence(F.lit(1), F.lit(positives))
    windows = pairs_with.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("w")  # at most ``positives``
    )
    filled = windows.select(
        "vec_id",
        F.transform(empty, lambda i: F.coalesce(F.get(F.col("w"), i - 1)["low"], F.lit(float("inf")))).alias("low"),
        F.transform(empty, lambda i: F.coalesce(F.get(F.col("w"), i - 1)["high"], F.lit(float("-inf")))).alias("high"),
    )
    sought = routed(anchors.join(filled, "vec_id").select(*_ASKED, "shard"), positives, False)
    found = _best(_search(trees, sought, tasks, negatives, positives, False), negatives, "anchor_id", "window")
    return pairs.join(found, ["anchor_id", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _oracle(every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> str:
    """For tables without repeated ids; labels as the registered query changes them."""
    return f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, len(embedding) AS dim,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id AND a.dim = b.dim WHERE a.vec_id % {every} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= {negatives}
"""


ORACLE_SQL = _oracle()
