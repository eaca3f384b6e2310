"""Every registered query against its SQL oracle (DuckDB) on the smallest tables;
rows-only keys must run and return rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, QUERIES[name], ORACLES[name], SF_SMALL)
    assert res["names_match"], res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["values_match"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.columns == ["n", "mse", "rmse", "mae", "r2"]
    assert out.count() == 1
