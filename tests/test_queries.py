"""Every query of the library against its SQL, on the smallest test tables."""

import pytest
from compare import assert_same, oracle_frame

import __spark_entry__ as driver
from tripmill.oracles import ORACLES
from tripmill.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, tables, name):
    assert_same(QUERIES[name](spark, tables), oracle_frame(tables, ORACLES[name]))


def test_entry(spark):
    assert driver.entry(spark).count() == 4764
