"""Connected components by alternating large and small stars.

Each round rewires every node towards the smallest node it knows (R. Kiveris et
al., "Connected Components in MapReduce and Beyond", 2014).  Neighbours are
never gathered: a round is a minimum per node (combined in each task first) and
a join, whose hot keys Spark can split.  A round's edges are written to the
shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that an edge names; the root is the component's smallest node."""
    now = materialise(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"), "edges")

    def mark(e: DataFrame) -> tuple:
        low, high = F.least("u", "v"), F.greatest("u", "v")
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(low, high)),
                           F.sum(F.xxhash64(high, low) % (1 << 31))).first())

    seen = mark(now)
    while seen[0]:
        now = materialise(_small_star(_large_star(now)), "edges")
        if (new := mark(now)) == seen:
            break
        seen = new
    # each node other than a root now has one edge, to its root
    leaves = now.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return materialise(leaves.unionAll(leaves.select(F.col("root").alias("node"), "root")).distinct(), "roots")
