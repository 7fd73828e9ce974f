"""Closures over levels: what can be reached from some nodes, in one plan whatever the number of levels."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def reached(edges: DataFrame, starts: DataFrame, depth: int, src: str = "src", dst: str = "dst", node: str = "node") -> DataFrame:
    """SC14, QS10: node, level for each node that is reached from `starts` in at most `depth` steps, with the fewest steps; starts are level 0. Null nodes lead nowhere and are left out.

    A recursive table: each level joins the rows of the one before with the edges, and nothing that was read before is read again. A way never comes
    back to a node that lies on it, so rings end. Several ways to a node are followed each; where many lead to one, give `depth`, and mind that
    Spark ends a recursion of over spark.sql.cteRecursionRowLimit rows with an error, not with fewer rows."""
    spark, tag = edges.sparkSession, uuid.uuid4().hex
    edges.select(edges[src].alias("src"), edges[dst].alias("dst")).dropna().distinct().createOrReplaceTempView(f"edges_{tag}")
    starts.select(starts[node].alias("node")).dropna().distinct().createOrReplaceTempView(f"starts_{tag}")
    return spark.sql(f"""
        WITH RECURSIVE way(node, level, path) MAX RECURSION LEVEL {depth + 1} AS (
          SELECT node, 0, array(node) FROM starts_{tag}
          UNION ALL
          SELECT e.dst, w.level + 1, array_append(w.path, e.dst) FROM way AS w JOIN edges_{tag} AS e ON w.node = e.src WHERE w.level < {depth} AND NOT array_contains(w.path, e.dst)
        )
        SELECT node, min(level) AS level FROM way GROUP BY node
    """)
