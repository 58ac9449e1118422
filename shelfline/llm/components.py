"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import settle


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the component's least node.

    Large-star and small-star rounds, each settled in the shared folder, until a round changes nothing. A
    node of very high degree is a hot join key that adaptive execution splits; minima combine before they
    move. Self loops and repeated edges do no harm; an edge with a NULL end is no edge.
    """
    now = settle(_oriented(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")), "edges")
    before = _print(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: every neighbour above a node points to the node's least neighbour.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        # Small star: a node and its lower neighbours point to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = settle(_oriented(small), "edges")
        after = _print(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", F.lit(7), "a"))).first())
