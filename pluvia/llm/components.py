"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.session import materialise


def _towards_least(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest of each node and its neighbours. A minimum is combined before the shuffle,
    so a node with very many neighbours is one row a task."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge of ``edges`` (a, b): root is the smallest node of its component.

    Large stars and small stars alternate until nothing changes; each round is written to the shared
    folder, so a lost executor costs a re-read and the plan does not grow. The number of rounds grows with the logarithm
    of the largest distance.
    """
    current = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_towards_least(both), "u").where("v > u and v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = large.join(_towards_least(large), "u")
        kept = small.select("u", F.col("least").alias("v"))
        moved = small.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        current = materialise(kept.unionByName(moved).distinct(), "edges")
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
