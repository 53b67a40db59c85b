"""Stateful streams: keys seen before, changed values, snapshots (T1-T3, T8), each with its batch twin."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_of_key(stream: DataFrame, key: str, time: str | None = None, within: str | None = None) -> DataFrame:
    """T1. A key's first record only. Without ``within`` for ever, as state that grows with the keys; with it, keys are forgotten after that long."""
    if within:
        return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def first_of_key_batch(df: DataFrame, key: str, order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_d")).select(key, "_d.*")


class ChangeProcessor(StatefulProcessor):
    """T2. Keeps the last value of a key and lets a record through if it is new or differs."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("at")
        old = self.last.get()[0] if self.last.exists() else None
        first, keep = not self.last.exists(), []
        for value in frame["value"]:
            keep.append(first or value != old)
            old, first = value, False
        self.last.update((old,))
        yield frame[keep][["key", "at", "value"]]

    def close(self) -> None:
        pass


def changed(stream: DataFrame) -> DataFrame:
    """T2, T3. (key, at, value) whose value differs from the key's last. Needs the RocksDB state store."""
    return stream.groupBy("key").transformWithStateInPandas(ChangeProcessor(), "key string, at timestamp, value string", "Append", "None")


def changed_batch(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The batch twin of ``changed``."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({"_n": F.row_number().over(w), "_old": F.lag(value).over(w)}).where((F.col("_n") == 1) | ~F.col(value).eqNullSafe(F.col("_old"))).drop("_n", "_old")


def daily_snapshots(df: DataFrame, key: str, time: str, value: str, delay: str | None = None) -> DataFrame:
    """T8. Of each key and day the value of its last record (ties: the greater value). A stream needs ``delay``, its watermark."""
    source = df.withWatermark(time, delay) if delay else df
    return source.groupBy(F.window(time, "1 day").alias("w"), key).agg(F.max_by(value, F.struct(time, value)).alias(value)).select(F.col("w.start").alias("day"), key, value)
