"""File, JDBC and stream sources."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Files whose size tells nothing of their content.
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"
EXTENSIONS = {"json": "*.json", "ttl": "*.ttl", "text": "*.txt"}


def messages(spark: SparkSession, path: str | Sequence[str], kind: str = "json", end: str = "\n") -> DataFrame:
    """S6, S7, S9, S10. (value, source) of all messages in files of a type, below a folder or in it.

    ``end`` closes a message; '' makes each file one message. What isn't closed at a file's end is dropped: one message that
    reads like the unclosed tail, as often as it may stand in the file. Files stay splittable.
    """
    read = spark.read.option("pathGlobFilter", EXTENSIONS[kind]).option("recursiveFileLookup", "false")
    if end == "":
        return read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source"))
    lines = read.text(path, lineSep=end).select("value", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_size").alias("_size"))
    tails = open_tails(lines, end)
    if tails is None:
        return lines.drop("_size")
    marked = lines.join(F.broadcast(tails), "source", "left")
    alike = marked.where(F.col("value") == F.col("tail")).groupBy("source", "value").count()
    return marked.where(F.col("tail").isNull() | (F.col("value") != F.col("tail"))).select("value", "source").union(
        alike.select("value", "source", F.explode(F.array_repeat(F.lit(1), (F.col("count") - 1).cast("int")))).select("value", "source")
    )


def open_tails(lines: DataFrame, end: str) -> DataFrame | None:
    """(source, tail) of the files that don't end in ``end``, or None: their messages, each with its end, are longer than the file. Only those files, which a writer left off in, and compressed ones are read once more."""
    sizes = lines.groupBy("source").agg(F.sum(F.octet_length("value") + len(end.encode())).alias("n"), F.max("_size").alias("size"))
    broken = [r[0] for r in sizes.where((F.col("n") > F.col("size")) | F.col("source").rlike(COMPRESSED)).select("source").collect()]
    if not broken:
        return None
    whole = lines.sparkSession.read.text(broken, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("source"), F.substring_index("value", end, -1).alias("tail")).where("tail <> ''")


def closed_messages(text: Column, end: str) -> Column:
    """S6, S7. The messages of a whole text; what its last end leaves open is dropped."""
    parts = F.split(F.coalesce(text, F.lit("")), quoted(end), -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def quoted(text: str) -> str:
    """A pattern for a text as it stands."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def parsed(raw: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """S8, J-4. Messages by a schema; those that aren't JSON objects go to the second table."""
    variant = F.try_parse_json("value")
    kind = F.schema_of_variant(variant)
    marked = raw.withColumn("_object", F.coalesce(kind.startswith("OBJECT"), F.lit(False)))
    good = marked.where("_object").select(F.from_json("value", schema).alias("m"), "source").select("m.*", "source")
    return good, marked.where("not _object").select("value", "source")


def jdbc(spark: SparkSession, url: str, query: str, types: dict[str, str] | None = None, fetch: int = 1000, **options: str) -> DataFrame:
    """S4, S16. A query of a database with enforced column types and lower-case names."""
    reader = spark.read.format("jdbc").options(url=url, query=query, fetchsize=fetch, **options)
    df = (reader.option("customSchema", ", ".join(f"{k} {v}" for k, v in types.items())) if types else reader).load()
    return df.toDF(*(c.lower() for c in df.columns))


def partitions_between(df: DataFrame, column: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """S21. Only partitions of an interval of days: a predicate on the partition column, so others aren't listed or read."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start.date()))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end.date()))
    return df


def topics(spark: SparkSession, servers: str, names: Sequence[str], starting: str = "earliest") -> DataFrame:
    """S13, T11. Several topics as one stream of text."""
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": ",".join(names), "startingOffsets": starting}).load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "timestamp")


def file_stream(spark: SparkSession, path: str, schema: str, form: str = "json", files_a_batch: int = 100) -> DataFrame:
    """S11, S15. New files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).format(form).load(path)


class CommandReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.command, self.key = options["command"], options.get("key", "")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition):
        import json
        import shlex
        import subprocess

        got = json.loads(subprocess.run(shlex.split(self.command), check=True, capture_output=True, text=True).stdout or "[]")
        for item in got if isinstance(got, list) else [got]:
            key = item
            for part in filter(None, self.key.split(".")):
                key = key.get(part) if isinstance(key, dict) else None
            yield (None if key is item or key is None else str(key), json.dumps(item, sort_keys=True))


class CommandSource(DataSource):
    """S14. The JSON array that a command prints, as (key, value) records; the key by a dotted path. ``spark.dataSource.register(CommandSource)``, then format 'command'."""

    @classmethod
    def name(cls) -> str:
        return "command"

    def schema(self) -> str:
        return "key string, value string"

    def reader(self, schema) -> CommandReader:
        return CommandReader(self.options)


def array_records(value: Column, schema: str) -> Column:
    """S14, T2. The elements of a JSON array, for ``inline``."""
    return F.from_json(value, f"array<{schema}>")


def source(spark: SparkSession, kind: str, path: str | Sequence[str] | None = None, form: str = "json", end: str = "\n") -> DataFrame:
    """S10-S12. Messages of files ('f'), of a distributed file system ('h'; without a path, of the files that standard input names), or of standard input ('s'; needs an end)."""
    if kind == "h" and path is None:
        path = [line.strip() for line in sys.stdin if line.strip()]
    if kind in ("f", "h"):
        if not path:
            raise ValueError("no path")
        return messages(spark, path, form, end)
    if kind != "s":
        raise ValueError(f"not a source: {kind}")
    if not end:
        raise ValueError("messages of standard input need an end")
    return spark.createDataFrame([(m, "stdin") for m in sys.stdin.read().split(end)[:-1]], "value string, source string")


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S29. The rows of files that hold one JSON array each."""
    return spark.read.schema(schema).json(path, multiLine=True)


def settings(text: str) -> dict[str, dict[str, str]]:
    """S30. The sections of an INI text; lines 'key=value' before any section, as of properties and shell files, are the section ''. Quotes around values and 'export ' are left out."""
    out: dict[str, dict[str, str]] = {"": {}}
    at = ""
    for line in text.splitlines():
        line = line.strip()
        if line.startswith("[") and line.endswith("]"):
            at = line[1:-1].strip()
            out.setdefault(at, {})
        elif "=" in line and line[0] not in "#;!":
            k, v = line.removeprefix("export ").split("=", 1)
            v = v.strip()
            out[at][k.strip()] = v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "'\"" else v
    return out
