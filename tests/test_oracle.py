"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

from oracle_check import compare, duck
from tillroll.plans.oracle import ORACLE_SQL
from tillroll.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    assert name in ORACLE_SQL
    ok, n, _, detail = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert ok, detail
    assert n > 0
