"""Connected components by alternating stars, on DataFrames only.

Each round points every node's larger neighbours, then its smaller ones, at the
smallest node around it. Minima are partial aggregates and the joins are on the
node, so a node with very many neighbours is split like any skewed join key.
Each round is written to the shared folder, which cuts the lineage; only a
count and a checksum of the edges reach the driver.

Defined cases: an edge with a NULL end is none; repeated edges count once; nodes
without an edge, and the smallest of each component, are not in the result; no
edges give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter("b > a").join(low, "a")
                .select(F.col("m").alias("a"), "b").filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the smaller to the larger node: (a, b), a < b."""
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(low, "b")
    return (moved.select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .unionByName(moved.select(F.col("m").alias("a"), "b"))
                 .filter("a != b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node that has an edge
    to a smaller one; ``edges`` has two long columns a, b."""
    e = written(edges.filter("a != b").select(F.least("a", "b").alias("a"),
                                              F.greatest("a", "b").alias("b")).distinct(), "edges")
    last = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if now["n"] == 0 or now == last:
            return e.select(F.col("b").alias("node"), F.col("a").alias("root"))
        last = now
        e = written(_small_star(_large_star(e)), "edges")
