"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.store import SMALL, stored
from matchlake.operators.joins import broadcast_if_small


def components(links: DataFrame, name: str, max_rounds: int = 100) -> DataFrame:
    """(node, label): for each node of ``links`` (a long, b long) the smallest
    node it is connected with.

    Alternating stars: a large star hangs every larger neighbour of a node on
    the node's smallest neighbour, a small star every smaller one and the node
    itself.  Each is a minimum per node (map-side combined) joined back, so a
    node of any degree spreads over tasks; the number of rounds grows with the
    logarithm of the longest path.  Each round is written and read back.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
                   f"{name}-links")
    for _ in range(max_rounds):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.where("b > a").join(broadcast_if_small(low, SMALL), "a")
                     .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b"))
        large = stored(large, f"{name}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(broadcast_if_small(low, SMALL), "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").where("a != b").distinct(), f"{name}-small")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) \
                .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on another."""
    below = edges.groupBy("a").agg(F.count("*").alias("n"))
    roots = edges.select(F.col("b").alias("a")).distinct()
    return below.where("n > 1").select("a").unionByName(below.join(broadcast_if_small(roots, SMALL), "a", "left_semi").select("a")).isEmpty()
