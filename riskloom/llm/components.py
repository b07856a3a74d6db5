"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import drop, written


def _with_least(arcs: DataFrame) -> DataFrame:
    """Adds ``m``, the least of a node ``u`` and its neighbours ``v``."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def _done(edges: DataFrame) -> bool:
    """Whether every node hangs on one root: no node has two parents, no parent has one."""
    two = edges.groupBy("u").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("u")
    inner = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return two.unionByName(inner).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v); the component is its
    smallest node. Self links and repeated links change nothing; links with a
    null end are ignored.

    Each round rewires every node to its least neighbour and writes the links to
    the shared folder; the number of rounds grows with the logarithm of the
    nodes. Nothing but "is there a row" reaches the driver.
    """
    edges = written(links.filter("u is not null and v is not null and u != v")
                    .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _done(edges):
        # a node hands its smaller neighbours and itself to the least of them
        least = _with_least(edges)
        small = least.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        # and its larger neighbours to its least one
        both = small.unionByName(small.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(large.distinct(), "links")
        drop(edges)
        edges = new
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
