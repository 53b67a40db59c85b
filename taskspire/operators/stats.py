"""The statistics queries: steps, campaigns, derivations, running tasks, hashtags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taskspire.functions.events import ratio_or_zero
from taskspire.operators.selection import ended_after_start, in_range, matches, not_bad
from taskspire.operators.steps import with_step
from taskspire.operators.units import duration_ms, kept_outputs, output_sum
from taskspire.schema import BAD_STATUSES, FINISHED_STATUSES, GENERAL_FORMATS


def _when_status(status: tuple[str, ...], c: Column) -> Column:
    return F.coalesce(F.sum(F.when(F.col("status").isin(*status), c)), F.lit(0))


def step_statistics(tasks: DataFrame, step_type: str = "step", layout: str = "flat", es_compat: bool = False) -> DataFrame:
    """A16. A row for each step over tasks that didn't fail.

    The events that count as done are total_events for steps and processed_events for formats. ``es_compat`` reproduces
    that for steps the events by status were never fetched: nothing is running, and finished tasks lack all their input.
    """
    t = with_step(tasks.where(not_bad()), step_type, layout)
    done = "total_events" if step_type == "step" else "processed_events"
    by_status = F.lit(0) if es_compat and step_type == "step" else F.col(done)
    agg = t.groupBy("step").agg(
        F.count("*").alias("total_tasks"),
        F.sum("input_events").alias("input_events"),
        F.sum("processed_events").alias("processed_events"),
        F.sum("total_events").alias("total_events"),
        F.sum("toths06_failed").alias("cpu_failed"),
        F.sum("toths06").alias("hs06"),
        F.sum(F.when(F.col("input_bytes") > 0, F.col("input_bytes"))).alias("input_bytes"),
        F.count(F.when(F.col("input_bytes") > 0, 1)).alias("input_not_removed_tasks"),
        F.sum(output_sum("bytes")).alias("output_bytes"),
        F.count(F.when(F.size(kept_outputs()) > 0, 1)).alias("output_not_removed_tasks"),
        F.avg(F.when(ended_after_start(), duration_ms())).alias("_duration"),
        F.count(F.when(F.col("status").isin(*FINISHED_STATUSES), 1)).alias("finished_tasks"),
        _when_status(FINISHED_STATUSES, F.when(F.col("input_bytes") > 0, F.col("input_bytes"))).alias("finished_bytes"),
        _when_status(("running",), F.col("input_events")).alias("_running_input"),
        _when_status(("running",), by_status).alias("_running_done"),
        _when_status(FINISHED_STATUSES, F.col("input_events")).alias("_finished_input"),
        _when_status(FINISHED_STATUSES, by_status).alias("_finished_done"),
    )
    known = F.coalesce(F.col("input_events") > 0, F.lit(False))
    share = lambda x: F.when(known, x / F.col("input_events") * 100)
    made = F.coalesce(done, F.lit(0))
    running = F.lit(0) if es_compat and step_type == "step" else F.col("_running_input") - F.col("_running_done")
    percent = share(made)
    clamped = F.when((percent > 99.99) & (made < F.col("input_events")), 99.99).otherwise(percent)
    status = F.when(~known, "Unknown").when(percent > 90, "StepDone").when(percent > 10, "StepProgressing").otherwise("StepNotStarted")
    return agg.withColumns({
        "duration": F.col("_duration") / 86_400_000, "percent_done": F.coalesce(clamped, F.lit(0.0)), "percent_running": F.coalesce(share(running), F.lit(0.0)),
        "percent_pending": F.coalesce(share(F.greatest(F.lit(0), F.col("input_events") - made - running - (F.col("_finished_input") - F.col("_finished_done")))), F.lit(100.0)),
        "running_events": F.when(known, running).otherwise(0), "finished_gap": F.when(known, F.col("_finished_input") - F.col("_finished_done")).otherwise(0), "step_status": status,
    }).drop("_duration", "_running_input", "_running_done", "_finished_input", "_finished_done")


def campaign_summary(tasks: DataFrame, now: datetime, step_type: str = "step", events_src: str = "all", layout: str = "flat") -> DataFrame:
    """A13-A15. A row for each step: input events (of tasks that didn't fail), output events of datasets and of finished tasks, ratios, first start, last end, tasks by status and those updated in the last 24 hours.

    ``events_src``: 'ds' (datasets), 'task' (processed events) or 'all'. A ratio is null where the input is 0 or missing.
    """
    t = with_step(tasks, step_type, layout)
    fresh = F.col("task_timestamp") >= F.lit(now) - F.expr("interval 1 day")
    agg = t.groupBy("step").agg(
        F.sum(F.when(not_bad(), F.col("input_events"))).alias("input_events"),
        F.coalesce(F.sum(output_sum("events", F.col("output_dataset"))), F.lit(0)).alias("output_ds"),
        _when_status(FINISHED_STATUSES, F.col("processed_events")).alias("output_task"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.max("task_timestamp").alias("last_update"),
        F.count("*").alias("tasks"), F.count(F.when(fresh, 1)).alias("updated_24h"),
    )
    of = lambda c: F.try_divide(F.col(c), F.nullif(F.col("input_events"), F.lit(0)))
    drop = {"ds": ["output_task", "ratio_task"], "task": ["output_ds", "ratio_ds"], "all": []}[events_src]
    return agg.withColumns({"ratio_ds": of("output_ds"), "ratio_task": of("output_task")}).drop(*drop)


def campaign_statuses(tasks: DataFrame, now: datetime, step_type: str = "step", layout: str = "flat", most: int | None = None) -> DataFrame:
    """A13. Tasks by step and status, and how many of them were updated in the last 24 hours; with ``most``, the statuses of most tasks of each step."""
    fresh = F.col("task_timestamp") >= F.lit(now) - F.expr("interval 1 day")
    out = with_step(tasks, step_type, layout).where("status is not null").groupBy("step", "status").agg(F.count("*").alias("tasks"), F.count(F.when(fresh, 1)).alias("updated_24h"))
    if most is None:
        return out
    from taskspire.operators.steps import first_of_each

    return first_of_each(out, ["step"], [F.desc("tasks"), F.col("status")], most)


def campaign_daily(tasks: DataFrame, step_type: str = "step", layout: str = "flat") -> DataFrame:
    """A17. By step and day of their end: events of finished tasks and of their datasets; days without tasks are left out."""
    t = with_step(tasks, step_type, layout).where(F.col("status").isin(*FINISHED_STATUSES) & F.col("end_time").isNotNull())
    return t.groupBy("step", F.to_date("end_time").alias("day")).agg(
        F.coalesce(F.sum(output_sum("events", F.col("output_dataset"))), F.lit(0)).alias("output_events"), F.coalesce(F.sum("processed_events"), F.lit(0)).alias("processed_events"), F.count("*").alias("tasks")
    )


def output_formats(tasks: DataFrame, exclude: tuple[str, ...] = GENERAL_FORMATS) -> DataFrame:
    """A10. The distinct formats of the tasks' datasets."""
    return tasks.select(F.explode("output_dataset.data_format").alias("output")).where(F.col("output").isNotNull() & ~F.col("output").isin(*exclude)).distinct()


def derivations_flat(tasks: DataFrame, exclude: tuple[str, ...] = GENERAL_FORMATS, most_ids: int = 100) -> DataFrame:
    """A11, J11. For each format: tasks with a dataset of that format and of some bytes (deleted or not), their input, and the not deleted datasets of the format. One pass for all formats; the parents' sums are not multiplied, as a task has one row for each of its formats."""
    picked = F.filter("output_dataset", lambda d: (d["bytes"] > 0) & ~d["data_format"].isin(*exclude))
    per = tasks.withColumn("output", F.explode(F.array_distinct(F.transform(picked, lambda d: d["data_format"]))))
    own = F.filter("output_dataset", lambda d: (d["deleted"] == F.lit(False)) & (d["data_format"] == F.col("output")))
    out = per.groupBy("output").agg(
        F.count("*").alias("tasks"), F.coalesce(F.sum("input_bytes"), F.lit(0)).alias("input_bytes"), F.coalesce(F.sum("requested_events"), F.lit(0)).alias("input_events"),
        F.sum(output_sum("bytes", own)).alias("output_bytes"), F.sum(output_sum("events", own)).alias("output_events"),
    )
    # the least ids of a format: each task of the map side passes on its own least ones only
    place = F.row_number().over(Window.partitionBy("output").orderBy("taskid"))
    least = per.select("output", "taskid").withColumn("place", place).where(F.col("place") <= most_ids).groupBy(F.col("output").alias("_of")).agg(F.array_sort(F.collect_list("taskid")).alias("task_ids"))
    return _with_ratios(out.join(least, F.col("output").eqNullSafe(F.col("_of")), "left").drop("_of"))


def derivations_nested(tasks: DataFrame) -> DataFrame:
    """A12, J14, J15. As the nested layout counts: the not deleted datasets of each format, and the sums over their distinct tasks."""
    kept = tasks.where(F.exists("output_dataset", lambda d: d["bytes"] > 0))
    rows = kept.select("taskid", "input_bytes", "requested_events", F.explode(kept_outputs()).alias("d")).where("d.data_format is not null")
    per_task = rows.groupBy(F.col("d.data_format").alias("output"), "taskid").agg(
        F.count("*").alias("n"), F.first("input_bytes").alias("ib"), F.first("requested_events").alias("ie"), F.sum("d.bytes").alias("ob"), F.sum("d.events").alias("oe")
    )
    out = per_task.groupBy("output").agg(*(F.coalesce(F.sum(a), F.lit(0)).alias(b) for a, b in (("n", "tasks"), ("ib", "input_bytes"), ("ie", "input_events"), ("ob", "output_bytes"), ("oe", "output_events"))))
    return _with_ratios(out)


def _with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({"ratio": ratio_or_zero(F.col("output_bytes"), F.col("input_bytes")), "events_ratio": ratio_or_zero(F.col("output_events"), F.col("input_events"))})


def running_days(tasks: DataFrame, hashtags: list[str] | None, now: datetime, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """A18. How many tasks were running on each day, by step. ``start`` bounds the end of tasks and ``end`` their start, so with ``start`` those still running are left out; a missing end is ``end``, or now."""
    p = not_bad() & F.col("start_time").isNotNull()
    if hashtags is not None:
        p = p & matches(tasks, "hashtag_list", hashtags)
    if start is not None:
        p = p & in_range("end_time", gte=F.lit(start))
    if end is not None:
        p = p & in_range("start_time", lte=F.lit(end))
    first, last = F.to_date("start_time"), F.to_date(F.coalesce("end_time", F.lit(end or now)))
    days = F.when(first <= last, F.sequence(first, last))
    return tasks.where(p & F.col("step_name").isNotNull()).select("step_name", F.explode(days).alias("day")).groupBy(F.col("step_name").alias("step"), "day").agg(F.count("*").alias("tasks"))


def binned_days(counts: DataFrame, bins: int) -> DataFrame:
    """U7. (step, day, tasks) by ``bins`` equal spans from the first day to the last, of all steps; a span's day is its first. The last day is in the last span."""
    first, last = (counts.agg(f("day")).scalar() for f in (F.min, F.max))
    days = F.greatest(F.datediff(last, first), F.lit(1))
    at = F.least(F.floor(F.datediff("day", first) * bins / days), F.lit(bins - 1)).cast("int")
    return counts.groupBy("step", at.alias("span")).agg(F.sum("tasks").alias("tasks")).select("step", F.date_add(first, F.ceil(F.col("span") * days / bins).cast("int")).alias("day"), "tasks")


def hashtag_statistics(tasks: DataFrame, hashtags: list[str]) -> DataFrame:
    """A26. By step, for tasks with one of the hashtags: events, bytes of inputs that are still there, CPU, time, bytes of datasets, tasks by status."""
    t = tasks.where(matches(tasks, "hashtag_list", hashtags) & F.col("step_name").isNotNull())
    has_input = F.col("input_bytes") > 0
    return t.groupBy(F.col("step_name").alias("step")).agg(
        F.count("*").alias("tasks"), F.sum("input_events").alias("input_events"), F.sum(F.when(has_input, F.col("input_bytes"))).alias("input_bytes"), F.sum("processed_events").alias("processed_events"),
        F.sum("toths06").alias("cpu_total"), F.sum("toths06_failed").alias("cpu_failed"), F.avg(F.when(ended_after_start(), duration_ms())).alias("walltime"), F.sum(output_sum("bytes")).alias("output_bytes"),
        F.count(F.when(F.col("status").isin(*FINISHED_STATUSES), 1)).alias("finished_tasks"), F.count(F.when(F.col("status").isin(*BAD_STATUSES), 1)).alias("bad_tasks"),
    )
