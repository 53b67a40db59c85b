"""Sinks (K1-K11, K13) and how they are retried, polled and reset."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def split_failed(df: DataFrame, error: str = "_error") -> tuple[DataFrame, DataFrame]:
    """K1. Outputs of records without an error, and the failed records: none of a failed record's outputs is written."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def write_new(df: DataFrame, path: str, form: str = "json") -> None:
    """K2, K3. Fails if the target is there."""
    df.write.mode("errorifexists").format(form).save(path)


def write_routed(df: DataFrame, path: str, column: str = "_index") -> None:
    """K5, K6. A folder for each target."""
    df.write.mode("append").partitionBy(column).parquet(path)


def bulk_lines(df: DataFrame, key: str = "_id") -> DataFrame:
    """K4. For each document its action line and its body, as one text with a newline between."""
    body = F.to_json(F.struct(*(c for c in df.columns if not c.startswith("_"))))
    target = F.struct(F.struct(F.col("_index").alias("_index"), F.col(key).alias("_id")).alias("a"))
    meta = F.regexp_extract(F.to_json(target), r'^\{"a":(.*)\}$', 1)
    head = F.concat(F.lit('{"'), F.col("_action"), F.lit('":'), meta, F.lit("}"))
    incomplete = F.coalesce(F.col("_incomplete"), F.lit(False)) if "_incomplete" in df.columns else F.lit(False)
    flagged = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.when(F.length(body) > 2, F.lit(",")).otherwise(F.lit("")), F.lit('"_update_required":true}'))
    changed = F.when(incomplete, F.concat(F.lit('{"doc":'), body, F.lit(',"upsert":'), flagged, F.lit("}"))).otherwise(F.concat(F.lit('{"doc":'), body, F.lit(',"doc_as_upsert":true}')))
    return df.select(F.concat(head, F.lit("\n"), F.when(F.col("_action") == "update", changed).otherwise(body)).alias("value"))


def retrying(call: Callable, times: int = 3, wait: float = 5.0) -> Callable:
    """T9. ``call``, tried again after an error up to ``times`` times in all, ``wait`` seconds apart; the last error is raised."""

    def run(*args, **kwargs):
        for n in range(1, times + 1):
            try:
                return call(*args, **kwargs)
            except Exception:
                if n == times:
                    raise
                time.sleep(wait)

    return run


def send_batches(df: DataFrame, send: Callable[[str], str], size: int = 100, tries: int = 3, wait: float = 5.0) -> DataFrame:
    """K6, K7, K10. (n, response): the texts in ``value`` sent in batches, joined by newlines, from the executors. ``size`` texts a batch; 0: as they arrive from Spark; below 0: one by one. A batch that fails is tried again; a lost executor's batches are sent anew, so the receiver must take repeats."""
    call = retrying(send, tries, wait)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left: list[str] = []
        for part in parts:
            left += part["value"].tolist()
            step = len(left) if size == 0 else max(1, size)
            while step and len(left) >= step:
                batch, left = left[:step], left[step:]
                yield pd.DataFrame({"n": [len(batch)], "response": [call("\n".join(batch))]})
        if left:
            yield pd.DataFrame({"n": [len(left)], "response": [call("\n".join(left))]})

    return df.select("value").where("value is not null").mapInPandas(run, "n long, response string")


def bulk_errors(responses: DataFrame) -> DataFrame:
    """K6. (action, _id, status, reason) of the records that a bulk response reports as failed."""
    item = "struct<_id:string,status:int,error:struct<reason:string>>"
    items = responses.select(F.explode(F.from_json("response", f"items array<map<string,{item}>>")["items"]).alias("i")).select(F.explode("i").alias("action", "r"))
    return items.where("r.error is not null").select("action", "r._id", "r.status", F.col("r.error.reason").alias("reason"))


def graph_updates(lines: DataFrame, graph: str) -> DataFrame:
    """K7. Each triple's line as a request that puts it into a graph."""
    return lines.select(F.concat(F.lit(f"INSERT DATA {{ GRAPH <{graph}> {{ "), "value", F.lit(" } };")).alias("value"))


def load_ontology(spark: SparkSession, path: str) -> DataFrame:
    """K8. The statements of an ontology's files, for a graph: a file each, as prefixes hold for a whole file."""
    return spark.read.text(path, wholetext=True, pathGlobFilter="*.ttl")


def poll(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str = "1 hour") -> StreamingQuery:
    """T6, T10. A function for each micro-batch of what has come since the last one, at intervals; a batch counts as done when the function returns."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def reset(spark: SparkSession, checkpoint: str) -> bool:
    """T12. Forgets the state and offsets of a stopped stream, or of windows: the next run starts from the beginning. Tells whether there were any."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))


def write_triples(df: DataFrame, path: str) -> None:
    """K7."""
    df.write.mode("append").text(path)


def create_table(spark: SparkSession, name: str, ddl: str, partition: str | None = None) -> None:
    """K8, K13."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet" + (f" PARTITIONED BY ({partition})" if partition else ""))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """K10, T6. A function for each micro-batch of what is there now."""
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """K9."""
    return df.select(F.to_json(F.struct("*")).alias("value")).writeStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}).start()


def fan_out(df: DataFrame, *branches: Callable[[DataFrame], None]) -> None:
    """K11. Several sinks of one computed table."""
    df.persist()
    try:
        for b in branches:
            b(df)
    finally:
        df.unpersist()
