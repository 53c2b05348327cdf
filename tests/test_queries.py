from __future__ import annotations

import pytest

import __spark_entry__ as driver
from chartfold.plans import landed
from chartfold.plans.oracles import ORACLES
from chartfold.plans.queries import QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    result = driver.entry(spark)
    assert "vitals_hash_key" in result.columns
    assert result.count() > 0


def test_every_query_has_its_sql():
    names = {*QUERIES, *landed.QUERIES}
    assert names == set(ORACLES)
    assert names <= set(driver.queries()) and names <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    compare(driver.queries()[name](spark, SF), ORACLES[name], con)
