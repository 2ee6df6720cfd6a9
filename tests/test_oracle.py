"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__
from datamove.checks import all_oracles, all_queries
from oracle import assert_matches

QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


def test_every_query_has_a_twin():
    assert all_queries().keys() == all_oracles().keys()


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, sf_dir, name):
    assert_matches(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name])


def test_flagship(spark, sf_dir):
    assert __spark_entry__.entry(spark).count() > 0
