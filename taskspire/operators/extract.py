"""Extraction of tasks from relational tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Job parameters and their patterns in a task's parameter text; the value is the first group.
PARAMETERS = {
    "architecture": r'"architecture": "([^",]+)',
    "core_count": r'"coreCount": ([0-9.]+)',
    "conditions_tag": r'"--conditionsTag[ =]\\"default:([a-zA-Z0-9_\-]+)',
    "geometry_version": r'"--geometryVersion[ =]\\"default:([a-zA-Z0-9_\-]+)',
    "ticket_id": r'"ticketID": "([^",]+)',
    "trans_home": r'"transHome": "([a-zA-Z0-9_.\-]+)',
    "trans_path": r'"transPath": "([^",]+)',
    "trans_uses": r'"transUses": "([^",]+)',
    "vo": r'"vo": "([a-zA-Z0-9_\-.]+)',
    "run_number": r'"--runNumber[ =]([0-9]+)',
    "trigger_config": r'"--triggerConfig[ =]\\"([^"\\]+)',
    "job_config": r'"--jobConfig[ =]\\"([^"\\]+)',
    "evgen_job_opts": r'"--evgenJobOpts[ =]\\"([^"\\]+)',
    "cloud": r'"cloud": "([^",]+)',
    "site": r'"site": "([^",]+)',
    "n_events_per_job": r'"nEventsPerJob": ([0-9]+)',
    "n_files_per_job": r'"nFilesPerJob": ([0-9]+)',
}
#: The request that stands for analysis; those above it are production.
ANALYSIS_REQUEST = 300


def job_parameters(text: Column | str) -> dict[str, Column]:
    """F10. All parameters found in a text; a missing one is null, never ''."""
    c = F.col(text) if isinstance(text, str) else text
    return {k: first_match(c, p) for k, p in PARAMETERS.items()}


def in_window(ts: Column | str, start: datetime | None, end: datetime | None) -> Column:
    """S1. start < ts <= end."""
    c = F.col(ts) if isinstance(ts, str) else ts
    p = F.lit(True)
    if start is not None:
        p = p & (c > F.lit(start))
    if end is not None:
        p = p & (c <= F.lit(end))
    return p


def kind_of(request: Column, kind: str) -> Column:
    """S3. 'production' or 'analysis'; a closed choice, never text put into a query."""
    return {"production": request > ANALYSIS_REQUEST, "analysis": request == ANALYSIS_REQUEST}[kind]


def list_of(df: DataFrame, key: str, value: str, name: str, separator: str = ", ") -> DataFrame:
    """A21, W1. The values of each key in order, joined: one row a key, so a join with it doesn't multiply rows."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(value)), separator).alias(name))


def extract_tasks(task: DataFrame, request: DataFrame, step: DataFrame, template: DataFrame, tag_link: DataFrame, tag: DataFrame, params: DataFrame, inputs: DataFrame, start: datetime | None, end: datetime | None, kind: str = "production") -> DataFrame:
    """J1-J5, W1-W3. Tasks of a window with their request, step, hashtags, job parameters, and input events.

    Of ``inputs`` only rows of type 'input' without a master count; they and the hashtags are added up before they are
    joined, so the many-to-many links multiply nothing and each is one shuffle on taskid. Only rows of the window's tasks are
    added up or searched for parameters. Repeated rows count once: each side is made distinct, so the wide result needn't be.
    """
    t = task.where(in_window("timestamp", start, end) & kind_of(F.col("pr_id"), kind))
    ids = t.select("taskid")
    tags = list_of(tag_link.join(ids, "taskid", "left_semi").join(tag, "ht_id"), "taskid", "hashtag", "hashtag_list")
    own = inputs.where("type = 'input' and masterid is null").withColumnRenamed("jeditaskid", "taskid").join(ids, "taskid", "left_semi")
    events = own.groupBy("taskid").agg(F.sum("nevents").alias("requested_events"), F.sum("neventsused").alias("_used"))
    named = params.join(ids, "taskid", "left_semi").select("taskid", *(c.alias(k) for k, c in job_parameters("jedi_task_parameters").items())).distinct()
    joined = t.distinct().join(request.select("pr_id", "description", "energy_gev").distinct(), "pr_id").join(step.join(template, "step_t_id").select("step_id", "step_name").distinct(), "step_id")
    out = joined.join(tags, "taskid", "left").join(named, "taskid", "left").join(events, "taskid", "left")
    return out.withColumn("processed_events", F.coalesce("_used", "total_events")).drop("_used")


def squash(rows: DataFrame, types: Iterable[str] = ("input", "output")) -> DataFrame:
    """A23. (taskid, type, datasetname) to one row a task with an array for each type; always arrays, null where there is none."""
    return rows.groupBy("taskid").agg(*(F.array_sort(F.collect_list(F.when(F.col("type") == t, F.col("datasetname")))).alias(t) for t in types)).select("taskid", *(F.when(F.size(t) > 0, F.col(t)).alias(t) for t in types))


def full_outer_update(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J10, U8. All keys of both; where a field is in both, the right one's value counts if it isn't null."""
    common = [c for c in left.columns if c in right.columns and c != key]
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in common})
    joined = left.join(r, key, "full_outer")
    return joined.select(key, *(F.coalesce(f"_r_{c}", c).alias(c) if c in common else F.col(c) for c in left.columns if c != key), *(c for c in right.columns if c not in common and c != key))


def status_sums(jobs: DataFrame, key: str = "jeditaskid") -> DataFrame:
    """A19. CPU of finished and failed jobs of each task, and of both."""
    of = lambda s: F.coalesce(F.sum(F.when(F.col("jobstatus") == s, F.col("hs06sec"))), F.lit(0))
    return jobs.where(F.col("jobstatus").isin("finished", "failed")).groupBy(key).agg(of("finished").alias("toths06_finished"), of("failed").alias("toths06_failed")).withColumn("toths06", F.col("toths06_finished") + F.col("toths06_failed"))


def task_datasets(task: DataFrame, sets: DataFrame, start: datetime | None, end: datetime | None, kind: str = "production") -> DataFrame:
    """J6. The output datasets of a window's tasks, a row each. Other task tables that add no field aren't joined, as they could only multiply rows."""
    t = task.where(in_window("timestamp", start, end) & kind_of(F.col("pr_id"), kind)).select("taskid")
    return sets.where("type = 'output'").withColumnRenamed("jeditaskid", "taskid").select("taskid", "datasetname").join(t, "taskid")


def task_keys(task: DataFrame, start: datetime | None, end: datetime | None, kind: str = "production") -> DataFrame:
    """S5. The distinct ids of a window's tasks, for the check of consistency."""
    return task.where(in_window("timestamp", start, end) & kind_of(F.col("pr_id"), kind)).select("taskid").distinct()


def of_campaign(df: DataFrame, campaign: str) -> DataFrame:
    """F12. Rows of a campaign, in any case of letters."""
    return df.where(F.lower("campaign") == campaign.lower())


def star(facts: DataFrame, *dimensions: tuple[DataFrame, Column]) -> DataFrame:
    """J7. Inner joins of a table with its dimensions, one after another; each condition may use the ones before it."""
    for table, on in dimensions:
        facts = facts.join(table, on)
    return facts


def with_summary(df: DataFrame, rows: DataFrame, key: str, **sums: Column) -> DataFrame:
    """J8, W5. What a correlated subquery would look up: aggregates of ``rows`` by the key, once, joined from the left. Keys without rows get nulls."""
    return df.join(rows.groupBy(key).agg(*(c.alias(n) for n, c in sums.items())), key, "left")


def with_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """A20, W2. Each row with its key's sum."""
    return rows.withColumn(name, F.sum(value).over(Window.partitionBy(key)))


def first_match(text: Column | str, pattern: str) -> Column:
    """F11. The first group of the first match; null, never '', without one."""
    return F.nullif(F.regexp_extract(F.col(text) if isinstance(text, str) else text, pattern, 1), F.lit(""))
