"""The plans taken when no side is small enough to broadcast, as at 100 TB:
same results through sort-merge joins."""

from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup
from tillroll.plans.registry import QUERIES
from tillroll.sources.testdata import table

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


def _without_broadcast(spark, fn):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cube_without_broadcast(spark, sf_small):
    expected = _rows(QUERIES["sales_cube"](spark, sf_small))

    def run():
        df = QUERIES["sales_cube"](spark, sf_small)
        rows = _rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString()
        return rows, plan
    rows, plan = _without_broadcast(spark, run)
    assert rows == expected
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_lookup_with_and_without_broadcast(spark, sf_small):
    lines = table(spark, sf_small, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf_small, "part").select("p_partkey", "p_retailprice")
    on = F.col("l_partkey") == F.col("p_partkey")
    small = lookup(lines, parts, on)
    plan = small._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SinglePartition" not in plan
    large = _without_broadcast(spark, lambda: _rows(lookup(lines, parts, on)))
    assert _rows(small) == large
    # a key missing from the dimension gives nulls, not a lost row
    missing = lookup(lines, parts.where("p_partkey > 10"), on)
    assert missing.count() == lines.count()
    assert missing.where("p_retailprice IS NULL").count() == lines.where("l_partkey <= 10").count()
