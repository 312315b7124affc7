from __future__ import annotations

import pytest

import __spark_entry__ as contract
import oracle
from gridspan.plans import catalog
from gridspan.plans import oracle as oracle_sql

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) == ""


#: Iterative, so without SQL; tests/test_exact.py holds one against a naive filter,
#: tests/test_recursion.py the other against the residuals one after the other.
NO_SQL = {"forecast_exact", "forecast_recursive"}


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) - NO_SQL == set(oracle_sql.ORACLE)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_iterative_forecasts_are_of_held_out_hours(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert rows and all(r.step > 0 and r.yhat is not None for r in rows)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[-2:] == ["Zone", "Value"] and df.count() > 0


@pytest.mark.parametrize("name", ["align_measures", "lag_features", "time_split", "last_wins",
                                  "validate_demand", "wide_to_long", "upsert_as_query"])
def test_no_cartesian_product(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
