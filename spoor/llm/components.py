"""Connected components of links, by alternating large and small stars.

Both stars only compare a node's neighbours with their least one: a window over the edges
of a node, which holds one number and spills the edges of a node of very many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spoor.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of ``links(a, b)``: the least node it reaches."""
    edges = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state, of_node = _state(edges), Window.partitionBy("a")
    while True:
        # Large star: greater neighbours of a node move to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = F.least(F.min("b").over(of_node), "a")
        large = both.withColumn("low", low).where("b > a").select(
            F.col("b").alias("a"), F.col("low").alias("b"))
        # Small star: lesser neighbours and the node itself move to the least of them.
        moved = large.withColumn("low", F.min("b").over(of_node)).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("a"), F.col("low").alias("b")))).alias("e"))
        edges = materialize(moved.select("e.a", "e.b").where("a <> b").distinct(), "small-star")
        now = _state(edges)
        if now == state:
            break
        state = now
    # Every edge now runs from a node to the least of its component.
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
