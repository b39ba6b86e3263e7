"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.texts import settled


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each batch as stars around the smallest id of their part; fewer links with the same components."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(parent.setdefault(a, a)), root(parent.setdefault(b, b))
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["a", "b"])


def _is_stars(edges: DataFrame) -> bool:
    """Whether every id has one link to a smaller one, or only links from larger ones: nothing is left to do."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """id, component for every id of `links` (columns a, b): the smallest id that is reachable.

    Only minima per node are aggregated, so a node with very many links is
    combined before the shuffle, and its rows are joined, which Spark can split.
    Every round is stored in the shared folder. Links with a null end or from an
    id to itself are left out.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    edges = settled(links.mapInArrow(_forests, "a long, b long").distinct())
    while not _is_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # Large star: every larger neighbour to the smallest of the neighbourhood.
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        # Small star: the node and its smaller neighbours to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))
        )).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = settled(small)
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
