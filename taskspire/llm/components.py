"""Connected components of a graph by alternating stars; no node, link or component is read back to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspire.llm.common import materialize

#: More rounds than a graph of any size here needs (the count is about the logarithm of the longest path).
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its greater neighbours to the least node it knows."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its lesser neighbours and itself to the least of them. Here a > b in each edge."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b: long): label is the least node of its component. Loops and repeated edges do no harm."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(MOST_ROUNDS):
        now = materialize(_small_star(_large_star(now)), "edges")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())
