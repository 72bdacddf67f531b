"""Connected components of an edge table, by repeated hooking onto the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import store_once


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the smallest node of its component.

    Alternates large-star and small-star steps, so a component of diameter D settles in O(log D) rounds, a star in two.
    Each step keeps at most one row per node and neighbour, combined before the shuffle, and is written to the shared
    folder, which cuts the lineage. Null ends and loops are ignored.
    """
    current = store_once(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a > b").distinct(), "edges")
    nodes = current.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    seen = _signature(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a > b").distinct())
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(root, "a")
                 .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a > b").distinct())
        current = store_once(small, "edges")
        before, seen = seen, _signature(current)
        if seen == before:
            break
    label = current.groupBy("a").agg(F.min("b").alias("label"))
    return nodes.join(label, nodes["node"] == label["a"], "left").select(
        "node", F.coalesce("label", "node").alias("label"))


def _signature(edges: DataFrame) -> tuple:
    """Count and order-free hash of an edge table; equal only for equal tables, but for a 2^-64 chance."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
