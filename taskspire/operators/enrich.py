"""Enrichment of tasks from other tables (S17, S20-S24, S26, J16, J18-J20, J22, P15, P16, P20, J-5, J-6, A29)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taskspire.functions.names import container, data_format, scope
from taskspire.operators.selection import incomplete


def by_key(df: DataFrame, key: str, value: object, fields: Sequence[str]) -> DataFrame:
    """S17. The fields of one row, found by its key."""
    return df.where(F.col(key) == value).select(*fields).limit(1)


def after(df: DataFrame, key: str, last: object | None) -> DataFrame:
    """S20. What comes after the last key seen, in order: a scan that can be taken up again."""
    return (df if last is None else df.where(F.col(key) > last)).orderBy(key)


def acceptable(df: DataFrame, key: str = "taskid") -> DataFrame:
    """P16. Rows with a key that isn't 0."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != 0))


def skipped(df: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """P15. A stage passed over: rows as they are, marked as incomplete."""
    return df.withColumns({**(defaults or {}), "_incomplete": F.lit(True)})


def first_hit(df: DataFrame, key: str, order: Column) -> DataFrame:
    """J19. One row a key, the first in the order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def first_hits(df: DataFrame, key: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """J19. The fields of each key's first row, as an aggregate: a hot key is added up before it is dealt. ``order`` must tell rows apart."""
    return df.groupBy(key).agg(F.min(F.struct(*order, *(F.col(f).alias(f"_{i}") for i, f in enumerate(fields)))).alias("_first")).select(key, *(F.col(f"_first._{i}").alias(f) for i, f in enumerate(fields)))


def record_id(url: Column | str) -> Column:
    """S24. The number of a record in the path of its address."""
    return F.regexp_extract(F.parse_url(F.col(url) if isinstance(url, str) else url, F.lit("PATH")), r"/record/(\d+)", 1).try_cast("long")


def in_collection(records: DataFrame, collections: Column | str, wanted: Sequence[str]) -> DataFrame:
    """S24. Records of one of the wanted collections; searches by code look only at these."""
    return records.where(F.arrays_overlap(collections, F.array(*map(F.lit, wanted))))


def dataset_facts(meta: DataFrame) -> DataFrame:
    """S22, J-6. (name, events, bytes, deleted) of a metadata table: the text 'null' is no value, and a dataset without bytes is deleted."""
    value = lambda c: F.nullif(F.col(c).cast("string"), F.lit("null")).cast("long")
    return meta.select("name", value("events").alias("events"), value("bytes").alias("bytes"), value("bytes").isNull().alias("deleted"))


def with_datasets(tasks: DataFrame, facts: DataFrame, names: str = "output") -> DataFrame:
    """J20, J14. ``output_dataset``, in the order of the array of names, with each one's facts and format; a dataset that isn't known counts as deleted. Also the facts of the primary input, and whether something is missing.

    The arrays are exploded and gathered once, by task; hot dataset names are spread by the join's skew handling.
    """
    each = tasks.select("taskid", F.posexplode(names).alias("at", "name"))
    known = each.join(facts, "name", "left").withColumns({"deleted": F.coalesce("deleted", F.lit(True)), "data_format": data_format("name")})
    gathered = known.groupBy("taskid").agg(F.array_sort(F.collect_list(F.struct("at", "name", "events", "bytes", "deleted", "data_format"))).alias("d"), F.max(F.col("events").isNull()).alias("_gap"))
    plain = F.transform("d", lambda x: F.struct(*(x[c].alias(c) for c in ("name", "events", "bytes", "deleted", "data_format"))))
    primary = facts.select(F.col("name").alias("primary_input"), F.col("events").alias("primary_input_events"), F.col("bytes").alias("input_bytes"), F.col("deleted").alias("primary_input_deleted"))
    out = tasks.join(gathered.withColumn("output_dataset", plain).drop("d"), "taskid", "left").join(primary, "primary_input", "left")
    return out.withColumn("primary_input_deleted", F.when(F.col("primary_input").isNotNull(), F.coalesce("primary_input_deleted", F.lit(True)))).withColumn("_incomplete", F.coalesce("_gap", F.lit(False)) | (F.col("primary_input").isNotNull() & F.col("input_bytes").isNull())).drop("_gap")


#: Scopes and formats for which parameters are kept; a dataset without a format also qualifies.
PARAMETER_SCOPES, PARAMETER_FORMATS = ("mc15", "mc16", "mc23"), ("AOD", "EVNT", "HITS")


def pivoted(rows: DataFrame, key: str, param: str, value: str, names: dict[str, str]) -> DataFrame:
    """S23. A long table as one row a key, with a column for each of ``names`` ({parameter: column}); of several values the greatest, so that the result doesn't depend on the order of rows."""
    return rows.groupBy(key).pivot(param, list(names)).agg(F.max(value)).withColumnsRenamed(names)


def with_parameters(sets: DataFrame, rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """S23, J-5, F4, P19. Datasets with parameters from a long table (name, param, value): those named in ``names`` become columns. Only for the scopes and formats above."""
    fits = F.regexp_extract(scope("name"), "^(mc[0-9]+)", 1).isin(*PARAMETER_SCOPES) & (F.col("data_format").isNull() | F.split("data_format", "_")[0].isin(*PARAMETER_FORMATS))
    wide = pivoted(rows.withColumnRenamed("name", "_container"), "_container", "param", "value", names)
    return sets.withColumn("_container", F.when(fits, container("name"))).join(wide, "_container", "left").drop("_container")


def with_jobs(tasks: DataFrame, sums: DataFrame, required: Sequence[str]) -> DataFrame:
    """J18, P20. Tasks with the sums of their jobs, marked where a required field is missing."""
    return tasks.join(sums, "taskid", "left").withColumn("_incomplete", incomplete(*required))


def assemble_papers(papers: DataFrame, notes: DataFrame, records: DataFrame) -> DataFrame:
    """S24, J22. Papers (id, code, notes: array of note ids) with their record, and their notes with theirs. A note without a record is left out, a paper is kept; of several records for a code the first counts."""
    first = first_hit(records, "code", F.col("record_id"))
    with_record = notes.join(first.select(F.col("code"), F.col("record").alias("note_record")), "code").select(F.col("id").alias("note_id"), "note_record")
    links = papers.select("id", F.explode("notes").alias("note_id")).join(with_record, "note_id").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("note_id", "note_record"))).alias("supporting_notes"))
    return papers.drop("notes").join(first.select("code", "record"), "code", "left").join(links, "id", "left")


def pdf_choice(files: Column | str) -> Column:
    """S26, A29. The address of the PDF of a paper: of files that end in .pdf and are described as full text, or not at all, the last."""
    fits = F.filter(F.col(files) if isinstance(files, str) else files, lambda f: F.lower(f["url"]).endswith(".pdf") & (f["description"].isNull() | F.lower(f["description"]).contains("fulltext")))
    return F.when(F.size(fits) > 0, F.element_at(fits, -1)["url"])


def inner_hits(tasks: DataFrame, n: int) -> DataFrame:
    """J16. Each task with its first n datasets."""
    return tasks.withColumn("output_dataset", F.slice("output_dataset", 1, n))
