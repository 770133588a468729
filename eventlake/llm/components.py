"""Connected components by alternating stars, as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import committed


def _pointing_down(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node to its smaller one."""
    return edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a > b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node that is reachable, for every node that has an edge (a, b).

    Loops and NULLs are ignored. Each round is committed; the number of rounds grows with the
    logarithm of the number of nodes.
    """

    def state(found: DataFrame) -> tuple:
        row = found.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        return row[0], row[1]

    found = committed(_pointing_down(edges.select("a", "b")))
    before = state(found)
    while before[0]:
        found = committed(_pointing_down(_small_star(_pointing_down(_large_star(found)))))
        after = state(found)
        if after == before:
            break
        before = after
    roots = found.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return found.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
