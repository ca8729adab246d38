"""Every registered query against its SQL twin, and the entry contract."""

import pytest

import __spark_entry__ as entry_module
from laminae.plans import catalog
from oracle import connect, run_pair

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    assert run_pair(spark, name, catalog.QUERIES[name], catalog.ORACLES.get(name), SF, con) is None


def test_entry_contract(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
