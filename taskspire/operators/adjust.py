"""The stages of the task pipeline put together."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspire.functions.categories import physics_category
from taskspire.functions.events import input_events, input_events_v2, processed_events_v2, with_chain
from taskspire.functions.names import format_steps, formats, hashtags, name_tags
from taskspire.functions.times import epoch_ms, round_time
from taskspire.operators.enrich import acceptable


def adjust(tasks: DataFrame) -> DataFrame:
    """Raw extracted tasks (strings for hashtags, formats and chain) to documents with all derived fields: one projection after another, no shuffle."""
    t = acceptable(tasks).withColumns({"_id": F.col("taskid").cast("string"), "hashtag_list": hashtags("hashtag_list"), "output_formats": formats("output_formats"), "ami_tags": name_tags("taskname")})
    t = with_chain(t)
    t = t.withColumns({"phys_category": physics_category("hashtag_list", "taskname"), "ctag_format_step": format_steps("output_formats", "ctag"), "ami_tags_format_step": format_steps("output_formats", "ami_tags")})
    t = t.withColumn("input_events", input_events()).withColumn("input_events_v2", input_events_v2()).withColumn("processed_events_v2", processed_events_v2())
    return t.drop("output")


def progress(tasks: DataFrame, granularity: timedelta = timedelta(days=1)) -> DataFrame:
    """T8 in batch. A snapshot row for each task and period; a task's id and the start of the period make its key."""
    at = round_time("task_timestamp", granularity)
    return tasks.withColumn("date", at).select(
        F.concat_ws("_", epoch_ms("date").cast("string"), F.col("taskid").cast("string")).alias("_id"), F.lit("progress").alias("_index"), "taskid", "date", "processed_events", "hashtag_list", "ami_tags_format_step", F.col("step_name").alias("mc_step"), "ctag_format_step"
    )
