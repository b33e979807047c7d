"""Connected components of a table of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; ``component`` is the smallest node reachable.

    Alternating stars: each round ties the larger neighbours of a node to the smallest one, then each node to its
    smallest neighbour, until every node points at its component's smallest node. A round is two groupings with
    map-side minima and two joins; its result is a table in shared storage, so lineage stays short and a lost
    executor costs one round. Minima are tables of their own, so adaptive execution can split the join of a node
    with very many links. Links with a null end and links of a node to itself say nothing and are left out.
    """
    pair = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = materialize(pair.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large")
        own = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "own")
        small = large.join(own, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(own.select("a", F.col("m").alias("b"))).distinct(), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one link down, to a node that has none."""
    twice = edges.groupBy("a").count().where("count > 1").select("a")
    chained = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    return twice.unionByName(chained).isEmpty()
