"""Connected components of an edge table by alternating large-star and small-star steps, each a DataFrame job.

A step is one aggregate (smallest neighbour per node, partial before the
shuffle), written as a table, and one join of the edges with it.  Both sides of
that join are plain shuffles of tables, which is what Spark's adaptive skew
join needs to split a node with very many neighbours; such a node is never
gathered.  Each step's edges are a written table too, so lineage does not grow
and a lost executor costs one step; the loop ends when a round changes nothing
(every component is then a star around its smallest node).

Defined results: edges may be in any order and repeated; an edge of a node with
itself makes no component.  An empty table has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, write_table


def both_ways(links: DataFrame) -> DataFrame:
    """Every edge from either end: (u, v)."""
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))


def smallest(pairs: DataFrame) -> DataFrame:
    """(node, low): the smallest of each node and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("low"))


def moved(pairs: DataFrame, low: DataFrame) -> DataFrame:
    """The neighbours of every node, now neighbours of its smallest; both sides are written tables."""
    return pairs.join(low, F.col("u") == F.col("node")).select(F.col("v").alias("a"), F.col("low").alias("b"))


def _step(links: DataFrame, large: bool) -> DataFrame:
    """One written step over edges (a > b).  large: every larger neighbour moves to the smallest; small: the smaller ones do."""
    pairs = both_ways(links) if large else links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = write_table(smallest(pairs), "low")
    edges = moved(pairs.filter("v > u") if large else pairs, low)
    if not large:
        edges = edges.union(low.select("node", "low"))
    found = write_table(edges.filter("a > b").distinct(), "links")
    drop_table(low)
    return found


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s")).first()
    return tuple(r)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)`` (longs, any order); root is the smallest node reachable."""
    links = write_table(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links"
    )
    state = _state(links)
    while state[0]:
        stars = _step(links, large=True)
        drop_table(links)
        links = _step(stars, large=False)
        drop_table(stars)
        before, state = state, _state(links)
        if before == state:
            break
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
