"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one lower node, and that on none: the stars are the components."""
    nodes = edges.groupBy("high").agg(F.count(F.lit(1)).alias("n"))
    centers = edges.select(F.col("low").alias("center")).distinct()
    open_ = nodes.join(centers, F.col("high") == F.col("center"), "left").filter("n > 1 OR center IS NOT NULL")
    return not open_.limit(1).count()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs neighbours of each node on the least of them and the node.

    Large stars move the neighbours above a node, small stars those below it.
    The least neighbour is found before the shuffle as far as it goes, written,
    and joined back, so a hub's neighbours are split over tasks.
    """
    sides = edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    if large:
        sides = sides.union(edges.select(F.col("low"), F.col("high")))
    least = stored(sides.groupBy("node").agg(F.min("other").alias("_m")).select(
        F.col("node").alias("_node"), F.least("node", "_m").alias("_m")), "least")
    joined = sides.join(least, F.col("node") == F.col("_node"))
    if large:
        moved = joined.filter(F.col("other") > F.col("node")).select(F.col("other").alias("high"), F.col("_m").alias("low"))
    else:
        moved = joined.filter(F.col("other") != F.col("_m")).select(F.col("other").alias("high"), F.col("_m").alias("low"))
        moved = moved.union(least.select(F.col("_node").alias("high"), F.col("_m").alias("low")))
    return stored(moved.filter(F.col("high") != F.col("low")).distinct(), "star")


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long) -> node, component (its least node), for nodes with an edge."""
    cur = stored(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    while not _settled(cur):
        cur = _star(_star(cur, True), False)
    roots = cur.select(F.col("low").alias("node")).distinct()
    return cur.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
