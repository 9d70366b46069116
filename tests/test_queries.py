"""Every registered query against its SQL, on the whole tables."""

import pytest
from check import differences
from conftest import SF

import __spark_entry__ as entry
from lakeops.suite import REGISTRY

WITH_SQL = sorted(n for n, q in REGISTRY.items() if q.sql is not None)
WITHOUT = sorted(n for n, q in REGISTRY.items() if q.sql is None)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, con, name):
    query = REGISTRY[name]
    assert differences(query.run(spark, SF), con, query.sql) is None


@pytest.mark.parametrize("name", WITHOUT)
def test_gives_rows(spark, name):
    assert REGISTRY[name].run(spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_query_ships_a_cartesian_product(spark):
    for name in ("city_metrics", "cross_city_comparison", "median_exact_lineitem", "layer_counts", "last_day_window"):
        plan = REGISTRY[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = REGISTRY["first_purchase"].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,605)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
