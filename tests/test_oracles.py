"""Every registered query against its DuckDB oracle (row multiset, column names)."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from surveyspark.plans import registry
from surveyspark.plans.fixtures import BASE_TABLES

from .conftest import SF_SMALL

registry.load_all()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES  # those of the library itself


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(tuple(v.asDict().values()))
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in v.items())
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_registered_with_most_oracles():
    assert len(QUERIES) >= 85
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= len(QUERIES) - 4


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    sc, sr = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLES[name])
    dc, dr = _rows(rel.columns, rel.fetchall())
    assert sc == dc
    assert sr == dr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["group", "n_records", "n_invasive", "invasive_share"]
    assert df.count() > 0
