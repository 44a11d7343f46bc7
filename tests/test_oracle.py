"""Every registered query against the SQL beside it, on the smallest tables."""

import os

import pytest
from compare import compare, connect

from vintagelake.checks import registry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert problem is None, problem
