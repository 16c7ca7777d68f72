"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import release, written


def _nearest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, combined before the shuffle: a hub is never gathered."""
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node with the smallest node around it."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = both.join(_nearest(both), "a").where("b > a")
    return moved.select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, with the smallest."""
    low = _nearest(edges)
    moved = edges.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(low.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``a, b``: the smallest node reachable. Edges from a node to itself and
    repeated edges change nothing; without edges the result is empty.

    Large and small stars alternate until all edges are stars. Each round is a written table, so that its lineage is
    short, and only two numbers per round reach the driver.
    """
    tidy = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, before = written(tidy, "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        last, now = now, written(_small_star(_large_star(now)), "edges")
        release(last)
    roots = now.select(F.col("b").alias("node")).distinct()
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionAll(roots.select("node", F.col("node").alias("component")))
