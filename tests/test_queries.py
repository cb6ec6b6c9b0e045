"""Every registered query against its DuckDB oracle on the smallest tables
(SURVEY §5 (2)), plus the driver contract."""

import pytest

import __spark_entry__ as E
from wellspring.plans.catalog import all_queries
from verify import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
NAMES = sorted(all_queries())


def test_contract():
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 60
    assert set(sql) <= set(qs)
    assert set(NAMES) <= set(qs)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "number_of_samples" in df.columns


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    r = compare(sp, con.execute(sql).fetchdf())
    assert r["ok"], r
