"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of edges (a, b); the component is its smallest node.

    A large star ties each larger neighbour of a node to the smallest of its neighbourhood, a small star
    does so for the smaller neighbours. Minima are pre-aggregated, so a node with very many neighbours is
    one row a task. Each round is written down; rounds grow with the logarithm of the longest path.

    Edge cases: repeated edges, edges of a node to itself and their order change nothing; a node that has
    only an edge to itself isn't returned; no edges, no rows.
    """
    now, names, before = edges.select("a", "b").where("a <> b").distinct(), [], None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        names.append(f"stars{len(names)}")
        now = scratch.save(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), names[-1])
        after = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 40)))).first()
        if after == before:
            break
        if len(names) > 1:
            scratch.drop(names[-2])
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
