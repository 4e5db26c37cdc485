"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.frames import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the long columns ``a`` and ``b``; root is the smallest node reachable.

    Every round hangs each node's larger neighbours, then its smaller ones, on the smallest
    node next to it, until nothing changes: a logarithmic number of rounds in practice, each
    linear in the edges. Hot nodes are combined before the shuffle as a minimum; the joins
    back have one row per node on one side, so adaptive execution can split the other.
    Self-loops, repeated edges and nulls are ignored; no edges give no rows.
    """
    now = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
