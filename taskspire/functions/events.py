"""Derived numbers of a task (M1-M5) and the chain string (R2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taskspire.functions.names import as_column


def truthy(c: Column | str) -> Column:
    """A number, or null where it is 0."""
    return F.nullif(as_column(c), F.lit(0))


def input_events() -> Column:
    """M1. Evgen: files to be used * events a job / files a job (1 if unknown), or the processed events if the files are unknown. Others: the lesser of requested and primary input, a missing one aside. Negative gives null."""
    files = F.expr("bigint(n_files_to_be_used) * coalesce(bigint(n_events_per_job), 0L) div coalesce(bigint(n_files_per_job), 1L)")
    generated = F.when(F.col("n_files_to_be_used").isNull(), F.col("processed_events")).otherwise(files)
    requested = F.coalesce(F.col("requested_events").cast("long"), F.lit(-1))
    primary = F.coalesce(F.col("primary_input_events").cast("long"), requested)
    other = F.when(requested < 0, primary).when(primary < 0, requested).otherwise(F.least(requested, primary))
    out = F.when(F.lower(F.coalesce("step_name", F.lit(""))) == "evgen", generated).otherwise(other)
    return F.when(out >= 0, out)


def input_events_v2(literal: bool = False) -> Column:
    """M2. First task of a chain: total requested, else primary input, else requested events (0 counts as unknown). Others: the parent's total unless it is a derivation, else requested. ``literal`` always takes the requested events of a task with a parent, as the original program does in effect."""
    root = F.coalesce(truthy("total_req_events"), truthy("primary_input_events"), F.col("requested_events"))
    if literal:
        return F.when(F.col("taskid") == F.col("chain_id"), root).otherwise(F.col("requested_events"))
    by_parent = F.col("parent_taskname").isNotNull() & ~F.col("parent_taskname").contains(".deriv.")
    return F.when(F.col("taskid") == F.col("chain_id"), root).when(by_parent, F.col("parent_total_events")).otherwise(F.col("requested_events"))


def processed_events_v2() -> Column:
    """M3. input_events_v2 * processed / requested, cut to a whole number; for Evgen, if one is unknown or 0, total_events."""
    known = F.col("input_events_v2") * F.col("processed_events") / F.nullif(F.col("requested_events"), F.lit(0))
    whole = truthy("input_events_v2").isNotNull() & truthy("processed_events").isNotNull() & truthy("requested_events").isNotNull()
    return F.when(whole, known.cast("long")).when(F.lower(F.coalesce("step_name", F.lit(""))) == "evgen", F.col("total_events"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    """M5."""
    return F.coalesce(F.try_divide(a, F.nullif(b, F.lit(0))), F.lit(0.0))


def with_chain(df):
    """R2. chain_data as ids, chain_id (its root), parent_taskname and parent_total_events from the element before the last. A missing or broken chain is the task alone."""
    df = df.withColumnRenamed("chain_data", "_chain")
    parts = F.split(F.col("_chain"), ",")
    ids = F.transform(parts, lambda x: F.substring_index(F.trim(x), ":", 1).try_cast("long"))
    sound = F.coalesce(F.size(F.filter(ids, lambda x: x.isNull())) == 0, F.lit(False)) & F.col("_chain").isNotNull()
    parent = F.split(F.when(sound & (F.size(parts) > 1), F.element_at(parts, -2)), ":")
    own = F.array(F.col("taskid").cast("long"))
    df = df.withColumns({"chain_data": F.when(sound, ids).otherwise(own), "parent_taskname": F.get(parent, F.lit(1)), "parent_total_events": F.get(parent, F.lit(2)).try_cast("long")})
    return df.withColumn("chain_id", F.get("chain_data", F.lit(0))).drop("_chain")
