"""Connected components of an edge table by repeated joins; nothing is gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paceline.session import staged


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node of ``edges``: the smallest node reachable from it.

    Each round gives a node the smallest root among its own and its neighbours', and then the root of
    that root, so chains shrink by doubling. Smallest values are combined before the shuffle, so a
    node with very many edges is no hot spot; its edges meet its label in a join that AQE can split.
    Ends when a round changes nothing. Edges to itself and repeated edges do no harm.
    """
    links = edges.select(F.col(left).alias("node"), F.col(right).alias("other"))
    links = staged(links.union(links.select("other", "node")).where("node <> other"), "links")
    roots = links.groupBy("node").agg(F.min("other").alias("root"))
    roots = staged(roots.withColumn("root", F.least("node", "root")), "roots")
    while True:
        near = links.join(roots.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("near"))
        better = roots.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = better.select(F.col("node").alias("root"), F.col("root").alias("further"))
        # A root is itself a node, so the join keeps every row.
        new = staged(better.join(jump, "root").select("node", "was", F.least("root", "further").alias("root")), "roots")
        if new.where("root <> was").isEmpty():
            return new.select("node", "root")
        roots = new.select("node", "root")
