"""Connected components of a link table, by stars, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage

MAX_ROUNDS = 60


def _lowest(links: DataFrame, node: str, other: str) -> DataFrame:
    """The least neighbour of each node. It is written, so that the join below can be split."""
    return cut_lineage(links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("least")))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's least neighbour (or the node)."""
    both = links.select("a", "b").unionAll(links.select(F.col("b"), F.col("a")))
    least = _lowest(both, "a", "b").select("node", F.least("node", "least").alias("least"))
    return both.filter("b > a").join(least, F.col("a") == F.col("node")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _lowest(down, "a", "b")
    hung = down.join(least, F.col("a") == F.col("node"))
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(
        least.select(F.col("node"), F.col("least"))
    )


def component_roots(links: DataFrame) -> DataFrame:
    """``node, root``: the least node of each component, for every node with a link.

    ``links`` has two bigint columns ``a`` and ``b``; order, repeated links and
    links of a node with itself don't matter, null ends are left out. Large-star
    and small-star rounds (Kiveris et al., 2014) alternate until nothing moves;
    the rounds grow with the logarithm of the longest chain. Every round is
    written to the shared folder, so a lost executor repeats one round at most.
    """
    links = links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    links = cut_lineage(links.filter("a <> b").distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        moved = _small_star(_large_star(links).filter("a <> b").distinct())
        links = cut_lineage(moved.filter("a <> b").distinct())
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
