"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlake.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is a component's least node.

    Alternates large-star and small-star steps, which keep at most as many edges as there
    were.  Each step is a minimum per node and a join; no neighbourhood is ever gathered, so
    a hub is no hot group: minima aggregate partially and the join can be split.
    Both steps are written to the shared scratch folder, which cuts lineage.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # Large star: every larger neighbour of a node is tied to the least node around it.
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        )
        # Small star: a node and its smaller neighbours are tied to the least of these.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select("a", "b", "least")
        after = (
            small.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(small.select("a", F.col("least").alias("b")))
            .where("a <> b")
            .distinct()
        )
        after = stored(after, "edges")
        if _sum(after) == _sum(now):
            # A star graph: every node is tied to its root alone.
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                after.select("b", "b").distinct()
            )
        now = after


def _sum(edges: DataFrame) -> tuple:
    """Size and order-free hash of an edge set."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]
