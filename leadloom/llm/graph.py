"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hot_join, live_cuts, remove, tidy


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"), F.count("*").alias("degree"))
    return hot_join(both, least, ["u"], "degree", 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
    moved = hot_join(edges, least, ["u"], "degree", n).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in edges (u, v) of any orderable type; root: the component's smallest node.

    Edges that join a node to itself are ignored. Each round writes its edges to
    the shared folder and deletes those of the round before; rounds end when the
    edges no longer change. The number of rounds grows with the logarithm of a
    component's size, not with its width.
    """
    now = cut(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            break
        since = live_cuts()
        after = cut(_small_star(cut(_large_star(now, mark[0])), mark[0]))
        tidy(now.sparkSession, since, after)
        remove(now.sparkSession, [now.cut_path])
        before, now = mark, after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
