"""Chains of tasks: lineage by parent (J9, W4) and the adjacency of chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longer chains than this stop the walk with an error rather than being cut.
MOST_LEVELS = 100


def lineage(links: DataFrame, write, most_levels: int = MOST_LEVELS) -> DataFrame:
    """J9. (taskid, chain, level) for ``links`` (taskid, parent): each task's path from its root to itself. A cycle ends where it would close.

    A row is a task, its path so far and its head, the next task above. Each round doubles the reach of every path (the
    head's path comes before it), so a chain of n tasks takes log n joins on the key; rows that are done sit out.
    ``write`` materialises a round.
    """
    tasks = links.groupBy("taskid").agg(F.min("parent").alias("parent"))  # one parent each
    known = tasks.select(F.col("taskid").alias("parent"), F.lit(True).alias("there"))
    parent = F.when(F.col("there") & (F.col("parent") != F.col("taskid")), F.col("parent"))
    now, reach = write(tasks.join(known, "parent", "left").select("taskid", F.array("taskid").alias("path"), parent.alias("head"))), 1
    while now.where("head is not null").limit(1).count():
        if reach > 2 * most_levels:
            raise RuntimeError(f"a chain is longer than {most_levels}")
        upper = now.select(F.col("taskid").alias("head"), F.reverse("path").alias("above"), F.col("head").alias("next"))
        joined = now.where("head is not null").join(upper, "head")
        # of the path above, nearest first, what comes before the first task that the own path has: a cycle ends there
        met = F.coalesce(F.array_position(F.transform("above", lambda x: F.array_contains("path", x)), F.lit(True)), F.lit(0)).cast("int")
        path = F.concat(F.reverse(F.when(F.col("met") > 0, F.slice("above", F.lit(1), F.col("met") - 1)).otherwise(F.col("above"))), "path")
        grown = joined.withColumn("met", met).withColumn("path", path).select("taskid", "path", F.when((F.col("met") == 0) & ~F.array_contains("path", F.col("next")), F.col("next")).alias("head"))
        now = write(now.where("head is null").unionByName(grown))
        reach *= 2
    return now.select("taskid", F.col("path").alias("chain"), F.size("path").alias("level"))


def adjacency(chains: DataFrame, column: str = "chain_data") -> DataFrame:
    """R3. (taskid, children) of all tasks in the chains: distinct neighbours of paths, sorted; tasks without children have none."""
    pairs = chains.select(F.explode(F.arrays_zip(F.slice(column, F.lit(1), F.size(column) - 1).alias("a"), F.slice(column, F.lit(2), F.greatest(F.size(column) - 1, F.lit(0))).alias("b"))).alias("p")).select("p.a", "p.b").distinct()
    nodes = chains.select(F.explode(column).alias("a")).distinct()
    return nodes.join(pairs, "a", "left").groupBy(F.col("a").alias("taskid")).agg(F.array_sort(F.collect_list("b")).alias("children"))


def chain_of(tasks: DataFrame, taskid: int) -> DataFrame:
    """The adjacency of the chain to which a task belongs; a task without a chain is its own root."""
    own = tasks.where(F.col("taskid") == taskid).select(F.coalesce("chain_id", "taskid").cast("long").alias("chain_id")).limit(1)
    return adjacency(tasks.withColumn("chain_id", F.coalesce("chain_id", "taskid").cast("long")).join(F.broadcast(own), "chain_id", "left_semi").withColumn("chain_data", F.coalesce("chain_data", F.array(F.col("taskid").cast("long")))))


def by_length(chains: DataFrame, column: str = "chain_data") -> DataFrame:
    """O5. Chains, the longest first; of equal ones by their tasks."""
    return chains.orderBy(F.desc(F.size(column)), column)
