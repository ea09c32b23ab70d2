"""Connected components of an undirected graph as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both(e: DataFrame) -> DataFrame:
    return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(e: DataFrame) -> bool:
    """Every node is either a root or hangs on one root."""
    ends = (e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
             .union(e.select("b", F.lit(0), F.lit(1))))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) for every end of ``edges`` (a, b): comp is the smallest
    node reachable.  Alternates large-star and small-star steps until every
    node hangs on its root, with a written table after each round; rows with a
    NULL end are ignored."""
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                  F.least("a", "b").alias("b")).distinct(), name)
    while not _stars(e):
        # large star: every larger neighbour of v moves to the least of v and its neighbours
        both = _both(e)
        low = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("m"))
        large = (both.join(low, both["a"] == low["v"]).filter("b > a")
                     .select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .filter("a <> b").distinct())
        # small star: v and its smaller neighbours move to the least of them
        down = large.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
        step = large.join(down, large["a"] == down["v"])
        small = (step.select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .union(down.select("v", "m")).filter("a <> b").distinct())
        e = materialize(small, name)
    star = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return star.union(roots)
