"""Each query of the catalogue against its SQL in DuckDB."""

import pytest
from conftest import rows_of

from taskspire.plans.catalogue import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small, duck):
    got = QUERIES[name](spark, small).toPandas()
    assert len(got) > 0
    if name in SQL:
        a, b = rows_of(got), rows_of(duck.execute(SQL[name]).df())
        assert a[0] == b[0]
        assert len(a[1]) == len(b[1])
        for x, y in zip(a[1], b[1], strict=True):
            assert all(u == v or (isinstance(u, (int, float)) and isinstance(v, (int, float)) and abs(u - v) < 1e-4) for u, v in zip(x, y, strict=True)), (x, y)


def test_round_ts_ndays_at_the_edges(spark, tmp_path):
    import duckdb

    c = duckdb.connect()
    edges = "unnest(['00:00:00', '07:59:59.7', '23:59:58.5', '23:59:59.499999', '23:59:59.5', '23:59:59.999999'])"
    c.execute(f"create table t as select (DATE '1969-12-01' + d::INTEGER)::VARCHAR || ' ' || {edges} as x from range(60) r(d) union all select (DATE '2024-01-01' + d::INTEGER)::VARCHAR || ' ' || {edges} from range(9) r(d) union all select null")
    c.execute(f"copy (select row_number() over () as event_id, x::timestamp as ts from t) to '{tmp_path}/events.parquet'")
    c.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    assert {tuple(r) for r in QUERIES["round_ts_ndays"](spark, str(tmp_path)).collect()} == set(c.execute(SQL["round_ts_ndays"]).fetchall())


def test_entry(spark, small):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
