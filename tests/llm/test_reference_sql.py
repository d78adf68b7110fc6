import pytest

from blockfee.llm.oracles import ORACLES
from blockfee.llm.queries import QUERIES
from tests.oracle import actual, expected

from .data import SF_DIR


def test_a_query_for_each_operator():
    assert [int(k.split("_")[0][2:]) for k in QUERIES] == list(range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_reference_sql(spark, name):
    types, rows = actual(QUERIES[name](spark, SF_DIR))
    expected_types, expected_rows = expected(ORACLES[name], SF_DIR)
    assert types == expected_types
    assert rows == expected_rows and rows
