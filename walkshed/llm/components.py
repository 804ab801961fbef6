"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkshed.llm.common import stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least neighbour of u. The minimum is combined before the shuffle."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return edges.join(least, F.col("u") == F.col("w")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _least_neighbour(both).where("v > u")
    return found.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    found = _least_neighbour(edges)
    ends = F.array(F.struct(F.col("u").alias("u")), F.struct(F.col("v").alias("u")))
    linked = found.select("m", F.inline(ends)).where("u != m")
    return linked.select("u", F.col("m").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that each node of an edge can reach.

    Large-star and small-star steps alternate until the edges are stars around the least
    nodes; each step is written to the shared folder. Nodes without an edge are not
    returned. Rows with a null or equal ends are no edges. An empty table gives an empty one.
    """
    x, y = F.col(a), F.col(b)
    edges = stage(
        edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges"
    )
    before = _mark(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
