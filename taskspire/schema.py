"""The data model: types of the task table, the dataset elements and the progress table, and fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element of a task's array of output datasets.
DATASET = "struct<name:string,events:bigint,bytes:bigint,deleted:boolean,data_format:string,k_factor:double,cross_section_ref:string,cross_section:double,gen_filt_eff:double,process_group:string,me_pdf:string>"

TASK = f"""
taskid int, taskname string, step_id int, step_name string, status string, pr_id int, campaign string, subcampaign string, project string,
phys_group string, site string, cloud string, description string, energy_gev int, architecture string, core_count smallint, conditions_tag string,
geometry_version string, ticket_id string, trans_home string, trans_path string, trans_uses string, user_name string, vo string, run_number int,
trigger_config string, job_config string, evgen_job_opts string, task_timestamp timestamp, start_time timestamp, end_time timestamp,
hashtag_list array<string>, phys_category array<string>, output_formats array<string>, ctag string, ami_tags string, ctag_format_step array<string>,
ami_tags_format_step array<string>, chain_id int, chain_data array<bigint>, parent_taskname string, parent_total_events bigint, primary_input string,
primary_input_events bigint, primary_input_deleted boolean, input_bytes bigint, total_events bigint, total_req_events bigint, requested_events bigint,
processed_events bigint, processed_events_v2 bigint, input_events bigint, input_events_v2 bigint, hs06 bigint, toths06 bigint, toths06_finished bigint,
toths06_failed bigint, n_files_per_job smallint, n_events_per_job bigint, n_files_to_be_used int, _update_required boolean, output_dataset array<{DATASET}>
"""  # noqa: E501

PROGRESS = "taskid int, date timestamp, processed_events bigint, hashtag_list array<string>, ami_tags_format_step array<string>, mc_step string, ctag_format_step array<string>"

# The order of production steps, statuses, field aliases, time format, types of steps.
MC_STEPS = ("Evgen", "Evgen Merge", "Simul", "Simul(Fast)", "Merge", "Digi", "Reco", "Rec Merge", "Atlfast", "Atlf Merge", "TAG", "Deriv", "Deriv Merge")
BAD_STATUSES = ("aborted", "failed", "broken", "obsolete")
FINISHED_STATUSES = ("done", "finished")
FIELD_ALIASES = {"amitag": "ctag", "htag": "hashtag_list", "pr": "pr_id"}
TIME_FORMAT = "dd-MM-yyyy HH:mm:ss"
STEP_TYPES = ("step", "ctag_format")
#: Formats that the flat layout's derivation statistics leave out.
GENERAL_FORMATS = ("DAOD", "DRAW")


def field_types(ddl: str) -> dict[str, str]:
    """Name and type of each field of a DDL string, at its top level."""
    from pyspark.sql.types import StructType

    return {f.name: f.dataType.simpleString() for f in StructType.fromDDL(ddl.replace("\n", " ")).fields}


def cast_task(df: DataFrame, ddl: str = TASK) -> DataFrame:
    """``df`` with the model's types: known fields are cast (times read by TIME_FORMAT if they are strings, a scalar made an array), missing ones are null, unknown ones stay."""
    have = dict(df.dtypes)
    out = []
    for name, kind in field_types(ddl).items():
        if name not in have:
            out.append(F.lit(None).cast(kind).alias(name))
        elif kind == "timestamp" and have[name] == "string":
            out.append(F.try_to_timestamp(F.col(name), F.lit(TIME_FORMAT)).alias(name))
        elif kind.startswith("array<") and not have[name].startswith("array"):
            out.append(F.when(F.col(name).isNotNull(), F.array(F.col(name))).cast(kind).alias(name))
        else:
            out.append(F.col(name).cast(kind).alias(name))
    return df.select(*out, *(F.col(c) for c in df.columns if c not in field_types(ddl)))


def datasets(tasks: DataFrame) -> DataFrame:
    """The child view: one row for each element of ``output_dataset``, with the task's id."""
    return tasks.select("taskid", F.explode("output_dataset").alias("d")).select("taskid", "d.*")
