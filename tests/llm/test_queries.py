import pytest
from compare import difference, oracle_connection

from fleetpulse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), oracle_connection(SF), ORACLES[name]) == ""
