"""Every query with SQL gives what DuckDB gives."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from gablework.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, small, name):
    result = QUERIES[name](spark, small).toArrow()
    assert compare(result, connect(small).sql(ORACLES[name]).to_arrow_table()) is None
    assert result.num_rows > 0


def test_ten_operators():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{i}" for i in range(1, 14)}
