"""Connected components of a table of edges, as repeated joins; labels never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: every neighbour of a node (larger ones, or the others and the node itself) moves to the least one.

    The least neighbours are stored, so that the edges of a hub meet them in a join of plain tables, which is split.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = materialize(least, "least")
        moved = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.filter(F.col("b") < F.col("a"))
        least = materialize(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def _moves(edges: DataFrame) -> bool:
    """Whether some node has several smaller neighbours, or one that has a smaller one itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not counts.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of (a, b); the root is the least node it is connected with.

    Rounds of large and small stars until every node is a root or a neighbour of its root only: their number grows with
    the logarithm of the nodes, and edges that are such stars from the start need none. Each round is written to the
    shared folder, so lost executors cost one round at most.
    """
    edges = materialize(
        edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while _moves(edges):
        edges = materialize(_star(materialize(_star(edges, True), "edges"), False), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
