"""Connected components of links as repeated joins, without gathering a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_signals.llm.staging import Stage


def _to_smaller(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node itself, point to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours point to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(node, component) of all nodes with a link: the smallest node reachable.

    `links` has two columns of ids, in any order and with repeats. Larger nodes are pointed to ever
    smaller ones until every node points to a root, which takes about log(length of the longest
    chain) rounds. A node's minimum is combined on the map side, and each round is a written table.
    """
    a, b = (F.col(c) for c in links.columns)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    done, kept = False, None
    for i in range(10_000):
        step = edges if i == 0 else _to_smaller(_to_smallest(edges))
        edges = stage.keep(step.where("u != v").distinct(), f"{name}-{i}")
        if kept:
            stage.drop(kept)
        kept = f"{name}-{i}"
        parents = edges.groupBy("u").agg(F.count("*").alias("n"))
        roots = edges.select(F.col("v").alias("u"), F.lit(True).alias("used")).distinct()
        state = parents.join(roots, "u", "left")
        done = state.where("n > 1 OR used").isEmpty()
        if done:
            break
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("v", "v"))
