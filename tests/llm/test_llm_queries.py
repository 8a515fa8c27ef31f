"""Registered queries against their SQL on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from tests.compare import check, connect
from traffic_lake.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(queries()) <= set(__spark_entry__.queries())
    assert set(oracle_sql()) <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    assert check(spark, connect(SF), SF, name, queries()[name], oracle_sql().get(name)) is None
