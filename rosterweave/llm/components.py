"""Connected components of a graph given by edges, by alternating stars.

Each round rewires edges to the smallest neighbour: first of a node's larger neighbours, then of a node and its smaller ones. It ends
when a round changes nothing; then every node has one edge, to the smallest node of its component. All tables stay on the executors.

A node's smallest neighbour is a plain aggregate, combined before the shuffle, and is joined back with the edges of nodes of very many
neighbours dealt over salts, since a large group soon is a star around one node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.llm.common import forget, salted_join, written


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """edges (a, b) with m, the smallest b of each a."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    return salted_join(edges, least, ["a"], "degree", total, F.xxhash64("b"), how="inner").select("a", "b", "m")


def components(edges: DataFrame, folder: str, name: str = "stars") -> DataFrame:
    """edges: a, b of one orderable type. node, root for each node with an edge to another; root is the smallest node reachable."""
    spark = edges.sparkSession
    at = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), folder, f"{name}0")
    seen, turn, total = None, 0, at.count()
    while True:
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, 2 * total).filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).filter("a <> b").distinct()
        large = written(large, folder, f"{name}{turn}_large")
        # a's smaller neighbours, all of them, and a itself go to the smallest of them
        small = _with_least(large, total).select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        turn += 1
        after = written(small.select("e.a", "e.b").filter("a <> b").distinct(), folder, f"{name}{turn}")
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        for old in (f"{name}{turn - 1}", f"{name}{turn - 1}_large"):
            forget(spark, f"{folder}/{old}")
        if tuple(mark) == seen:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        at, seen, total = after, tuple(mark), mark[0]
