"""Connected components of an edge table, as Spark joins (alternating large and small stars,
Kiveris et al. 2014). Nodes are longs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from svcvitals.sources.tables import materialize


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node has one parent at most, and parents have none."""
    roles = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("root")),
                                           F.struct(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("root")))).alias("r")).select("r.*")
    nodes = roles.groupBy("v").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return not nodes.filter("up + root > 1").head(1)


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of edges (a, b); null ends and
    loops are dropped. Each round is written to the shared folder."""
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_star_forest(edges):
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = materialize(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


__all__ = ["components"]
