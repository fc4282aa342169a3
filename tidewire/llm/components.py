"""Connected components by alternating stars, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """Directed (u, v) with ``m``, the least of u and its neighbours. A node with very many edges is a large partition
    of the join, which the adaptive skew join splits; the minimum is taken map-side first."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down)
    return starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        starred.select("u", F.col("m").alias("v"))
    )


def _tidy(edges: DataFrame) -> DataFrame:
    return materialize(edges.where("u != v").distinct(), "stars")


def _digest(edges: DataFrame) -> tuple:
    # The sum is over wrapped parts, so it cannot overflow.
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link in ``links`` (u long, v long); the root is the least node of its component.

    Each round makes nodes point to smaller ones of their component, until nothing changes: a number of rounds that
    grows with the logarithm of the longest path. Rounds are written to the shared folder; only counts come back.
    """
    edges = _tidy(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    before = _digest(edges)
    while True:
        edges = _tidy(_small_star(_large_star(edges)))
        now = _digest(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
