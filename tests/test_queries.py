"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from traffic_lake.plans import entry, oracle_sql, queries

from .compare import check, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_its_sql(spark, duck, name):
    assert check(spark, duck, SF, name, queries()[name], oracle_sql()[name]) is None


def test_entry_registers_them():
    assert set(queries()) <= set(__spark_entry__.queries())
    assert set(oracle_sql()) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["prioridad", "zona", "categoria_dia", "n"] and df.count() > 0
