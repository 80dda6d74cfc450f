"""Every registered query against its DuckDB oracle on sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from servicelake.plans.registry import REGISTRY
from servicelake.sources.fixtures import TABLES
from tests.conftest import SF_SMALL

QUERIES = REGISTRY  # what else the entry module registers has tests of its own
ORACLES = {name: sql for name, sql in entry_mod.oracle_sql().items() if name in REGISTRY}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "sla_breach_rate" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLES[name])
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 1
