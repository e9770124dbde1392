"""What several operators share: table reading, Arrow slices, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.session import stored

#: Rows of a table that one Python step holds at a time.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that long texts do not add up."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; remainder 2 is held out. Null ids: remainder 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4, F.lit(0))


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(doc_id) == 2


def _spread(edges: DataFrame, up: bool) -> DataFrame:
    """One round on undirected edges (a, b), a != b, each held once.

    up: every node sends the smallest node around it to its larger neighbours;
    else to its smaller neighbours and itself. The smallest node is aggregated
    map-side, and the join back is one that Spark can split, so a node with very
    many neighbours is no single task.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not up:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if up:
        sent = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        sent = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        sent = sent.union(least.select("a", F.col("m").alias("b")))
    return sent.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it reaches.

    Alternates the large-star and small-star steps until every edge points at a
    root; the number of rounds grows with the logarithm of the longest chain.
    Each round is written to the shared folder, so a lost executor repeats one
    round at most. No edges: no rows.
    """
    edges = stored(edges.select("a", "b").filter("a != b").distinct())
    before = None
    while True:
        edges = stored(_spread(_spread(edges, up=True), up=False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def bounded(rows: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """At most about ``limit`` rows, chosen by a hash of their key; all if there are no more."""
    count = rows.count()
    if count <= limit:
        return rows
    bits = 1 << 30
    chosen = F.xxhash64(F.lit("sample"), key).bitwiseAND(bits - 1)
    return rows.filter(chosen < int(bits * limit / count))
