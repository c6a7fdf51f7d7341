"""Connected components of link tables, distributed, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every linked node; component is the smallest node reachable. links: long columns a and b.

    Large-star and small-star rounds, written to the shared folder after each: a hub's neighbours move to its smallest one, so chains halve
    and no row holds a neighbourhood. The hub's minimum is a partial aggregate; joining it back splits under AQE's skew handling.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct()
    edges = materialize(edges, "links")
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: greater neighbours of a node link to the smallest of its neighbourhood
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a node's smaller neighbours link to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "a", "m")
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        after = materialize(moved, "links")
        same = after.count() == edges.count() and after.join(edges, ["a", "b"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
