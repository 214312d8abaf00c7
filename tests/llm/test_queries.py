import pytest
from compare import compare, oracle_connection

from formline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, key):
    result = compare(spark, oracle_connection(sf_dir), sf_dir, QUERIES[key], ORACLES[key])
    assert result["equal"], result
    assert result["types"] == {}, result
    assert result["rows"]


def test_one_query_per_operator():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
