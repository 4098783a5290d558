"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def roots(links: DataFrame, label: str = "links", max_rounds: int = 100) -> DataFrame:
    """(a, b) links between nodes -> (node, root) with the smallest node of each component; nodes without links are absent.

    Every round is written to the shared folder. The number of rounds grows with the logarithm of the longest chain.
    """
    current = staged(_small_star(links).distinct(), label)
    mark = None
    for _ in range(max_rounds):
        current = staged(_small_star(_large_star(current)).distinct(), label)
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")
        ).first()
        if (state["n"], state["h"]) == mark:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = (state["n"], state["h"])
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
