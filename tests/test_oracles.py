"""Every registered query against its DuckDB oracle at sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from tessera.plans import registry as E
from tessera.sources.tables import TABLE_NAMES
from tests.conftest import SF001

ORACLES = E.oracles()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(cols) > 0
        return
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert _rows(rows, cols) == _rows(res.fetchall(), ocols)


def test_entry_smoke(spark):
    import __spark_entry__
    df = __spark_entry__.entry(spark)
    assert df.columns == ["b", "cnt_a", "sum_c", "sum_d"] and df.count() >= 0
