"""Connected components of a link table by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import materialize


def roots(edges: DataFrame) -> DataFrame:
    """node, root for every node of the links a, b (longs): root is one node of its component, the same for all of them.

    Each round points every node at the least of itself and its neighbours, follows the pointers twice, and replaces both ends of
    each link by where they point. Links within one root go; rounds end with the last link. Self-links and repeats are harmless,
    nodes without links don't appear. All steps are aggregates with partial sums and equi-joins; nothing reaches the driver.
    """
    live = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "live")
    place = None
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        points = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("to")), "points")
        hop = points.select(F.col("node").alias("to"), F.col("to").alias("next"))
        for _ in range(2):
            points = points.join(hop, "to").select("node", F.col("next").alias("to"))
        points = materialize(points, "points")
        if place is None:
            place = points.select("node", F.col("to").alias("root"))
        else:
            moved = points.select(F.col("node").alias("root"), "to")
            place = materialize(place.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "place")
        left = live.join(points.select(F.col("node").alias("a"), F.col("to").alias("ra")), "a").join(points.select(F.col("node").alias("b"), F.col("to").alias("rb")), "b")
        live = materialize(left.filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "live")
    if place is None:
        return edges.filter(F.lit(False)).select(F.col("a").alias("node"), F.col("b").alias("root"))
    return place


def extended(place: DataFrame, edges: DataFrame) -> DataFrame:
    """What roots() gives for the links of place, which it gave before, and edges: only edges are contracted, between the roots of place."""
    end = lambda c: place.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    moved = edges.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    more = roots(moved)
    old = place.join(more.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return materialize(old.union(more.join(place.select("node"), "node", "left_anti").select("node", "root")), "place")
