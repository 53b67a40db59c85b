"""Incremental scans by windows of time with a control table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession


def windows(start: datetime, end: datetime, step: int, clip: bool = True) -> Iterator[tuple[datetime, datetime]]:
    """S1, S2. Consecutive windows (a, b] of ``step`` seconds, backwards if it is negative. ``clip`` shortens the last to the end; else only full windows come."""
    if not step:
        raise ValueError("the step is 0")
    by, at = timedelta(seconds=abs(step)), start
    if step > 0:
        while at < end:
            to = at + by
            if to > end:
                if not clip:
                    return
                to = end
            yield at, to
            at = to
    else:
        at = end
        while at > start:
            to = at - by
            if to < start:
                if not clip:
                    return
                to = start
            yield to, at
            at = to


@dataclass
class Offset:
    """The time up to which all has been read, or, where windows go backwards, down to which; in a folder that Spark reaches."""

    spark: SparkSession
    path: str

    def get(self, default: datetime, backwards: bool = False) -> datetime:
        from pyspark.errors import AnalysisException

        try:
            row = self.spark.read.parquet(self.path).agg({"upto": "min" if backwards else "max"}).first()
        except AnalysisException:
            return default
        return row[0] or default

    def commit(self, upto: datetime) -> None:
        self.spark.createDataFrame([(upto,)], "upto timestamp").coalesce(1).write.mode("append").parquet(self.path)


def run_windows(offset: Offset, start: datetime, end: datetime, step: int, extract: Callable[[datetime, datetime], DataFrame], load: Callable[[DataFrame], None]) -> int:
    """T7. Loads each window and then commits its far edge: at least once. A run that was broken off goes on from there, in either direction. Returns how many windows were loaded."""
    done = 0
    first, last = (offset.get(start), end) if step > 0 else (start, offset.get(end, backwards=True))
    for a, b in windows(first, last, step):
        load(extract(a, b))
        offset.commit(b if step > 0 else a)
        done += 1
    return done


def tasks_query(kind: str) -> str:
    """S3. The saved query of a window; the operator is one of two, times and the request are parameters of ``spark.sql``."""
    sign = {"production": ">", "analysis": "="}[kind]
    return f"SELECT * FROM production_task WHERE timestamp > :start AND timestamp <= :end AND pr_id {sign} :request"
