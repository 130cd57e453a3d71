"""Every query of the retail operators against its SQL."""

import oracle
import pytest

import __spark_entry__ as registered
from ledgerloom.workload.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, connection):
    frame = QUERIES[name](spark, sf_dir)
    assert oracle.differences(frame, connection, ORACLE_SQL[name]) is None


def test_entry(spark, sf_dir):
    assert registered.entry(spark).count() > 0
    assert set(ORACLE_SQL) == set(QUERIES)
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLE_SQL.items() <= registered.oracle_sql().items()
