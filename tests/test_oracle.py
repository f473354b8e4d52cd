"""Every query against its SQL."""

import pytest

from workload import ORACLE, QUERIES
from workload.check import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    n, faults = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert not faults
    assert n > 0
