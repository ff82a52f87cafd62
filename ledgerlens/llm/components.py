"""Connected components of an edge table, by alternating large and small stars.

Every step is a join and an aggregation with map-side partial minima; the edges
are written to the shared folder after each round, so lineage stays short and a
lost executor costs one round.  Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, run_folder


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): root is the smallest node reachable; nodes without an edge are absent."""
    at = run_folder(edges.sparkSession, "components")
    now, mark, step = land(_ordered(edges), f"{at}/0"), None, 0
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h")).first()
        if state.n == 0 or (state.n, state.h) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark, step = (state.n, state.h), step + 1
        now = land(_small_star(_large_star(now)), f"{at}/{step}")


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node; loops go."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _ordered(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a")
    return _ordered(tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))
