import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from tests.oracle import actual, expected

SF_DIR = "/root/testdata/sf0.01"


def test_every_query_has_reference_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_reference_sql(spark, name):
    types, rows = actual(QUERIES[name](spark, SF_DIR))
    expected_types, expected_rows = expected(ORACLES[name], SF_DIR)
    assert types == expected_types
    assert len(rows) == len(expected_rows) > 0
    assert rows == expected_rows


def test_entry(spark):
    assert entry(spark).columns == ["height", "fee_btc"]
