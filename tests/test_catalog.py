"""Every registered query against its SQL."""
import pytest

import __spark_entry__ as entry
from compare import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert differences(spark, SF, QUERIES[name], ORACLES[name], con) == []
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 548
