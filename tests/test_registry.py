"""Every registered query with SQL gives the rows of its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from lexmill import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"create view {t.split('.')[0]} as select * from read_parquet('{SF}/{t}')")
    return con


def _rows(rows, at):
    clean = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(clean(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    df = registry.queries()[name](spark, SF)
    want = tables.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    assert _rows(df.collect(), cols) == _rows(want.fetchall(), [want.columns.index(c) for c in cols])


def test_driver_contract():
    made, sql = entry.queries(), entry.oracle_sql()
    assert set(registry.queries()) <= set(made) and set(sql) <= set(made) and "sim_join_part_names" in made
