"""Connected components of a graph given as edges, by alternating star contractions.

A large star hangs every larger neighbour of a node on the least node it sees; a small star does the
same with the smaller neighbours.  Both keep the components, and a few rounds leave each node on
the least node of its component.  Every round is written to the shared folder, which cuts lineage;
the driver reads one row per round.  Least neighbours are written before they are joined, so that
both sides of the join are plain exchanges, which adaptive execution can split at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import saved, scratch_folder


def _hang(edges: DataFrame, folder: str) -> DataFrame:
    """``edges`` (a, b) with ``m``, the least of a and all its b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return edges.join(saved(least, folder), "a")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the least node reachable.

    Nodes without an edge to another node do not occur; no edges give no rows.
    """
    spark = edges.sparkSession
    folder = scratch_folder(spark, "components")
    ordered = edges.where("a != b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
    now, seen, turn = saved(ordered.distinct(), f"{folder}/0"), None, 0
    while True:
        turn += 1
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _hang(both, f"{folder}/{turn}-large-least").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = saved(large, f"{folder}/{turn}-large")
        hung = _hang(large, f"{folder}/{turn}-small-least")
        small = hung.select("a", F.col("m").alias("b")).unionAll(
            hung.select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a != b").distinct()
        now = saved(small, f"{folder}/{turn}")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(state)
