"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from compare import compare, duck_connect
from ledgerlake.oracle import ORACLE
from ledgerlake.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
    assert res["ok"] is True and res["rows"] > 0, res


def test_queries_and_oracles_are_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_spend" in df.columns
