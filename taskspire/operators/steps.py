"""Buckets of processing steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taskspire.schema import MC_STEPS


def with_step(tasks: DataFrame, step_type: str, layout: str = "flat") -> DataFrame:
    """``tasks`` with ``step``: the step's name, or 'format:tag' for each format of a task, which is then in several buckets.

    flat: from the formats of the task and its tag; nested: from the array ctag_format_step.
    """
    if step_type == "step":
        return tasks.where("step_name is not null").withColumn("step", F.col("step_name"))
    if step_type != "ctag_format":
        raise ValueError(f"unknown step type: {step_type}")
    if layout == "nested":
        return tasks.withColumn("step", F.explode(F.array_distinct("ctag_format_step")))
    return tasks.where("ctag is not null").withColumn("_format", F.explode(F.array_distinct("output_formats"))).withColumn("step", F.concat_ws(":", "_format", "ctag")).drop("_format")


def top(df: DataFrame, by: list[str], count: str, k: int = 10) -> DataFrame:
    """A24. The k buckets of most rows (ties: the lesser key). Its input is already grouped, so it is as small as the number of buckets."""
    return df.orderBy(F.desc(count), *by).limit(k)


def first_of_each(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """W5. The first k rows of each key."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_place") <= k).drop("_place")


def step_order(step: Column) -> Column:
    """O2. The place in the fixed order; unknown names come last."""
    place = F.array_position(F.array(*map(F.lit, MC_STEPS)), step)
    return F.when(place > 0, place).otherwise(len(MC_STEPS) + 1)


def chart_order(step: Column) -> Column:
    """O7."""
    order = ("Evgen", "Simul", "Reco", "Deriv", "Merge")
    place = F.array_position(F.array(*map(F.lit, order)), step)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def merged_name(step: Column) -> Column:
    """U7. All merging steps as one series; its points are kept side by side, not added up."""
    return F.when(step.contains("Merge"), "Merge").otherwise(step)
