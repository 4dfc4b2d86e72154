"""Every query with SQL gives what DuckDB gives; every other query gives rows."""

from __future__ import annotations

import pytest
from oracle_check import SMALL, compare, connect

from gablework.catalog import ORACLES, QUERIES

# Covered by tests of their own; each of these fits many models.
SLOW = {"stack_meta", "sweep_stack", "grid_search_trees", "model_round_trip", "gbt_fit", "gbt_leafwise", "gbt_dart_leaves"}


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    result = QUERIES[name](spark, SMALL).toArrow()
    assert compare(result, db.sql(ORACLES[name]).to_arrow_table()) is None
    assert result.num_rows > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
