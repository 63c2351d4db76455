"""Every core query with SQL gives what the SQL gives."""

from __future__ import annotations

import pytest

from klipgrid.plans import catalog, general

from conftest import DATA, compare

QUERIES, SQL = {**catalog.QUERIES, **general.QUERIES}, {**catalog.SQL, **general.SQL}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    compare(spark, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", ["p4_found", "p5_found", "window_metrics", "reject_counts", "planned_picks"])
def test_same_as_sql_under_production_plans(production, name):
    compare(production, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
