"""The domain's tables, mapped from the generic test tables: tasks from orders and their line items, dimensions from the rest.

Each mapping is given twice, as a DataFrame and as SQL for the comparison (common table expressions).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taskspire.schema import MC_STEPS

#: The clock of all queries over the test tables.
NOW = datetime(2001, 8, 2)
# Fixed values of the mapping: names by number.
SHORTS = ("ttbar_lep", "Upsilon_mumu", "zmumu", "3topjetstanb_wenu_", "h125_gg", "none", "singletop_wt", "dijet_jets")
TAGS = ("ttbar", "diphoton", "qcd", "higgs", "susy", "w", "upgrad", "none")
FORMATS = ("AOD", "DAOD", "DRAW", "HITS", "EVNT", "DAOD_SUSY1")


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pick(values: tuple[str, ...], n: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (n % len(values)).cast("int"))


def cents(c: str) -> Column:
    return F.floor(F.col(c) * 100 + 0.5).cast("long")


def child_rows(spark: SparkSession, d: str) -> DataFrame:
    """Output datasets, one row each."""
    fmt = pick(FORMATS, F.col("l_partkey"))
    return read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("taskid"), F.col("l_linenumber").alias("position"), F.concat_ws(".", F.lit("mc16_13TeV"), F.col("l_partkey").cast("string"), F.lit("gen"), F.lit("deriv"), fmt, F.concat(F.lit("r"), F.col("l_suppkey").cast("string"))).alias("name"),
        fmt.alias("data_format"), (F.floor("l_quantity") * 10).cast("long").alias("events"), cents("l_extendedprice").alias("bytes"), (F.col("l_linestatus") == "F").alias("deleted"), F.col("l_shipdate").alias("shipped"),
    )


def tasks(spark: SparkSession, d: str) -> DataFrame:
    """Tasks with their nested datasets. Line items and orders meet on the task's id, in one shuffle of each."""
    sets = child_rows(spark, d).groupBy("taskid").agg(
        F.max("shipped").alias("end_time"), F.sum("events").alias("processed_events"), F.array_sort(F.collect_list(F.struct("position", "name", "data_format", "events", "bytes", "deleted"))).alias("output_dataset")
    )
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    step, project, ctag = pick(MC_STEPS, cust), F.concat(F.lit("mc"), (15 + cust % 3).cast("string")), F.concat(F.lit("r"), (cust % 40).cast("string"))
    status = F.when(key % 10 == 0, "failed").when(key % 10 == 1, "aborted").when(key % 10 == 2, "running").when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "O", "running").otherwise("done")
    o = read(spark, d, "orders").select(
        key.alias("taskid"), cust.alias("pr_id"), step.alias("step_name"), status.alias("status"), project.alias("project"), ctag.alias("ctag"),
        F.concat(project, F.lit("_13TeV."), key.cast("string"), F.lit("."), pick(SHORTS, cust), F.lit("."), F.lower(F.replace(step, F.lit(" "), F.lit(""))), F.lit("."), ctag).alias("taskname"),
        F.when(key % 17 != 0, F.col("o_orderdate")).alias("start_time"), F.col("o_orderdate").alias("task_timestamp"),
        F.when(key % 13 == 0, 0).when(key % 7 != 0, F.floor(price)).cast("long").alias("input_events"), F.floor(price).cast("long").alias("requested_events"),
        F.when(key % 6 == 0, 0).when(key % 5 != 0, cents("o_totalprice")).cast("long").alias("input_bytes"), F.floor(price / 10).cast("long").alias("toths06"), F.floor(price / 100).cast("long").alias("toths06_failed"),
        F.concat(F.lit("mc16."), F.when(key % 3 == 0, "AOD").when(key % 3 == 1, "rpvll").otherwise("EVNT"), F.lit(".x")).alias("primary_input"),
        F.when(cust % 4 != 0, F.array(pick(TAGS, cust), project)).alias("hashtag_list"),
    )
    return o.join(sets, "taskid", "left").withColumns({
        "total_events": F.col("processed_events") + F.col("pr_id") % 5, "output_formats": F.array_sort(F.array_distinct("output_dataset.data_format")),
    })


def tasks_and_children(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return tasks(spark, d), child_rows(spark, d)


def sql_pick(values: tuple[str, ...], n: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], (({n}) % {len(values)} + 1)::INTEGER)"


_FMT, _STEP = sql_pick(FORMATS, "l_partkey"), sql_pick(MC_STEPS, "o_custkey")
#: ds (datasets) and tasks (without the nested array) as common table expressions.
CTES = f"""
ds AS (
  SELECT l_orderkey AS taskid, l_linenumber AS position, concat_ws('.', 'mc16_13TeV', l_partkey::VARCHAR, 'gen', 'deriv', {_FMT}, 'r' || l_suppkey::VARCHAR) AS name,
    {_FMT} AS data_format, (floor(l_quantity) * 10)::BIGINT AS events, floor(l_extendedprice * 100 + 0.5)::BIGINT AS bytes, l_linestatus = 'F' AS deleted, l_shipdate AS shipped
  FROM lineitem
), dsum AS (
  SELECT taskid, max(shipped) AS end_time, sum(events)::BIGINT AS processed_events, sum(bytes)::BIGINT AS all_bytes, sum(CASE WHEN NOT deleted THEN bytes ELSE 0 END)::BIGINT AS kept_bytes,
    sum(CASE WHEN NOT deleted THEN events ELSE 0 END)::BIGINT AS kept_events, sum(CASE WHEN NOT deleted THEN 1 ELSE 0 END)::BIGINT AS kept_sets FROM ds GROUP BY taskid
), tasks AS (
  SELECT o_orderkey AS taskid, o_custkey AS pr_id, {_STEP} AS step_name,
    CASE WHEN o_orderkey % 10 = 0 THEN 'failed' WHEN o_orderkey % 10 = 1 THEN 'aborted' WHEN o_orderkey % 10 = 2 THEN 'running' WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'O' THEN 'running' ELSE 'done' END AS status,
    'mc' || (15 + o_custkey % 3) AS project, 'r' || (o_custkey % 40) AS ctag,
    'mc' || (15 + o_custkey % 3) || '_13TeV.' || o_orderkey || '.' || {sql_pick(SHORTS, "o_custkey")} || '.' || lower(replace({_STEP}, ' ', '')) || '.r' || (o_custkey % 40) AS taskname,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END AS start_time, o_orderdate AS task_timestamp,
    (CASE WHEN o_orderkey % 13 = 0 THEN 0 WHEN o_orderkey % 7 <> 0 THEN floor(o_totalprice) END)::BIGINT AS input_events, floor(o_totalprice)::BIGINT AS requested_events,
    (CASE WHEN o_orderkey % 6 = 0 THEN 0 WHEN o_orderkey % 5 <> 0 THEN floor(o_totalprice * 100 + 0.5) END)::BIGINT AS input_bytes, floor(o_totalprice / 10)::BIGINT AS toths06, floor(o_totalprice / 100)::BIGINT AS toths06_failed,
    'mc16.' || CASE WHEN o_orderkey % 3 = 0 THEN 'AOD' WHEN o_orderkey % 3 = 1 THEN 'rpvll' ELSE 'EVNT' END || '.x' AS primary_input,
    CASE WHEN o_custkey % 4 <> 0 THEN [{sql_pick(TAGS, "o_custkey")}, 'mc' || (15 + o_custkey % 3)] END AS hashtag_list,
    dsum.end_time, dsum.processed_events, dsum.processed_events + o_custkey % 5 AS total_events, kept_bytes, kept_events, kept_sets
  FROM orders LEFT JOIN dsum ON dsum.taskid = o_orderkey
)
"""
