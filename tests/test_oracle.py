"""Every registered query against its DuckDB SQL (sf0.001 here; the driver
runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from blotter.plans.queries import registry
from oracle_check import compare, duck

from conftest import SF001

# Queries that the entry adds to these are tested beside their operators.
NAMES = sorted(registry())
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(SQL) and set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF001, E.queries()[name], SQL.get(name))
    assert r["status"] in ("OK", "no-oracle"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["area", "area_name", "incidents"]
