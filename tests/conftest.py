from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    os.environ.setdefault("TZ", "UTC")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider").getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return c


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    """Columns and rows in a comparable form: columns by name, rows sorted, floats rounded."""
    import pandas as pd

    frame = frame[sorted(frame.columns)]

    def plain(x):
        if hasattr(x, "item"):
            x = x.item()
        if x is None or (not isinstance(x, (list, dict, str)) and pd.isna(x)):
            return None
        return round(float(x), 5) if isinstance(x, float) else x

    return list(frame.columns), sorted((tuple(plain(x) for x in r) for r in frame.itertuples(index=False)), key=str)
