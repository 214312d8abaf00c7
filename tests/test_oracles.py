"""Every registered query against its SQL twin, whole tables at the smallest scale."""

import os

import pytest
from compare import compare, oracle_connection

from formline.plans.oracles import ORACLES
from formline.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, con, key):
    result = compare(spark, con, SF_DIR, QUERIES[key], ORACLES[key])
    assert result["equal"], result
    assert result["types"] == {}, result


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
