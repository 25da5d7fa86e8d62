"""The driver contract."""

import __spark_entry__ as entry_mod
from tillroll.plans.oracle import ORACLE_SQL
from tillroll.plans.registry import QUERIES


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 25


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE_SQL) <= set(entry_mod.oracle_sql())
