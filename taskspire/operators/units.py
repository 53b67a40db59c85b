"""Aggregation units (A1-A6): names of units to the columns of one ``groupBy().agg()``.

Units: 'count'; a field (its sum); 'hs06' and 'hs06_failed' (sums of toths06, toths06_failed); 'task_duration' (mean, in
milliseconds, over tasks that ended after their start); 'last_update'. Prefixes: 'input__unit' counts only tasks with input
bytes; 'output__unit' goes over the not deleted output datasets; 'status__unit' and 'status' give a map by status.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspire.operators.selection import ended_after_start

ALIASES = {"hs06": "toths06", "hs06_failed": "toths06_failed"}


def duration_ms() -> Column:
    return F.unix_millis(F.col("end_time").cast("timestamp")) - F.unix_millis(F.col("start_time").cast("timestamp"))


def kept_outputs() -> Column:
    return F.filter("output_dataset", lambda d: d["deleted"] == F.lit(False))


def output_sum(field: str, array: Column | None = None) -> Column:
    """The sum of a field over a task's not deleted output datasets, without exploding them."""
    return F.aggregate(F.transform(kept_outputs() if array is None else array, lambda d: F.coalesce(d[field].cast("long"), F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)


def _unit(unit: str, when: Column | None = None) -> Column:
    guard = lambda c: c if when is None else F.when(when, c)
    if unit == "count":
        return F.count(guard(F.lit(1)))
    if unit == "task_duration":
        return F.avg(guard(F.when(ended_after_start(), duration_ms())))
    if unit == "last_update":
        return F.max(guard(F.col("task_timestamp")))
    return F.sum(guard(F.col(ALIASES.get(unit, unit))))


def unit_column(unit: str) -> Column:
    """The aggregate of one unit, under the unit's name."""
    prefix, _, inner = unit.partition("__")
    if prefix == "input":
        return _unit(inner or "count", F.col("input_bytes") > 0).alias(unit)
    if prefix in ("output", "output_dataset"):
        return (F.sum(F.size(kept_outputs())) if not inner or inner == "count" else F.sum(output_sum(inner))).alias(unit)
    return _unit(unit).alias(unit)


def aggregate(df: DataFrame, by: Sequence[str], units: Sequence[str]) -> DataFrame:
    """All units in one pass; those by status are folded into maps in a second, small one."""
    plain = [u for u in units if u.split("__")[0] != "status"]
    by_status = [u for u in units if u.split("__")[0] == "status"]
    if not by_status:
        return df.groupBy(*by).agg(*map(unit_column, plain))
    if not plain:
        plain = ["count"]
    inner = [u.partition("__")[2] or "count" for u in by_status]
    counted = df.where("status is not null").groupBy(*by, F.col("status").alias("_status")).agg(*(_unit(i).alias(f"_{u}_value") for i, u in zip(inner, by_status, strict=True)))
    maps = counted.groupBy(*by).agg(*(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_status", F.col(f"_{u}_value").alias("value"))))).alias(u) for u in by_status))
    return df.groupBy(*by).agg(*map(unit_column, plain)).join(maps, list(by), "left") if by else df.agg(*map(unit_column, plain)).crossJoin(maps)
