"""Connected components of a graph of links, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barloom.session import BROADCAST_ROWS, settle


def _fingerprint(edges: DataFrame) -> tuple:
    """Two sets of links that are steps of one computation are equal if these are."""
    hashed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum("b"), F.sum(hashed)).head())


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(node, component)``, the component being its smallest node.

    Alternates two steps until nothing changes: each node hands its larger neighbours to its
    smallest one, then its smaller neighbours likewise. Links stay as many as there are nodes, the
    depth halves, and every step is settled. Where links are few enough, the smallest neighbours are sent to
    every task, so that links are not shuffled to meet them. A result can be given back with further links.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                F.least("a", "b").alias("b")).distinct(), "links")
    now = _fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        sent = F.broadcast if now[0] <= BROADCAST_ROWS // 2 else lambda least: least    # each link has two nodes
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        # a link that is handed on twice is made one by the next step
        larger = settle(both.where("b > a").join(sent(least), "a")
                        .select(F.col("b").alias("a"), F.col("least").alias("b")), "larger")
        least = larger.groupBy("a").agg(F.min("b").alias("least"))
        smaller = (larger.join(sent(least), "a").select(F.col("b").alias("x"), "least")
                   .where("x <> least").select(F.col("x").alias("a"), F.col("least").alias("b"))
                   .union(least.select("a", F.col("least").alias("b"))).distinct())
        after = settle(smaller, "smaller")
        before, now = now, _fingerprint(after)
        if before == now:
            roots = after.select(F.col("b").alias("node")).distinct()
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                roots.select("node", F.col("node").alias("component")))
        edges = after
