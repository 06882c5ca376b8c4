"""Queries with SQL against DuckDB at sf0.001, float bits included."""

import os

import duckdb
import pytest

from tessera.llm.queries import ORACLES, QUERIES
from tests.conftest import SF001


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF001, t)}.parquet')")
    df = QUERIES[name](spark, SF001)
    found = _key([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert found == _key(res.fetchall(), cols)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
