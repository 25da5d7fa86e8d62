"""Skewed inputs: a third of all rows on one key or one repeated row.

Results stay exact, and the plans aggregate partially before every shuffle
of raw rows, so the hot group reaches the reducer as one row per map task.
"""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import contracts
from tillroll.operators.cells import cell_aggregate, cells_with_tenths
from tillroll.operators.dedup import dedup_full_row
from tillroll.operators.rollups import grouped_rollups
from tillroll.plans.cube import sales_cube
from tillroll.sources.generator import generate_sales

AS_OF = dt.date(2025, 5, 20)


def _hot_copies(spark, base, copies):
    """``copies`` exact copies of the first generated row, made on the executors."""
    row = base.where("sale_id = 1")
    return row.select(F.explode(F.array_repeat(F.struct(*base.columns), copies)).alias("r")) \
        .select("r.*").repartition(8)


def test_repeated_row_collapses(spark):
    base = generate_sales(spark, 6000, AS_OF, num_partitions=4)
    skewed = base.unionAll(_hot_copies(spark, base, 3000))
    assert dedup_full_row(skewed).count() == base.count()
    a = sales_cube(skewed)
    b = sales_cube(base)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = dedup_full_row(skewed)._jdf.queryExecution().sparkPlan().toString()
    # partial aggregate below the exchange and final above it
    assert plan.count("HashAggregate") == 2


def test_hot_cell_pre_aggregates(spark):
    base = generate_sales(spark, 6000, AS_OF, num_partitions=4)
    hot = base.where("region = 'North'").withColumn("product_id", F.lit(1)) \
        .withColumn("sale_date", F.lit(AS_OF - dt.timedelta(days=30)))
    sales = hot.unionAll(base.where("region <> 'North'"))
    for aggregate in (cell_aggregate(sales), grouped_rollups(cells_with_tenths(sales), ["region", "product_id"])):
        plan = aggregate._jdf.queryExecution().sparkPlan().toString()
        assert "partial_sum" in plan and "partial_count" in plan
    cube = sales_cube(sales)
    cell = cube.where("region = 'North'").collect()
    assert len(cell) == 1 and cell[0]["count_sales"] == base.where("region = 'North'").count()


def test_hot_key_in_pk_check(spark):
    base = generate_sales(spark, 3000, AS_OF)
    hot = spark.range(1000).select(F.lit(7).cast("long").alias("sale_id"))
    v = contracts.pk_violations(base.select("sale_id").unionAll(hot)).collect()
    assert [(r.sale_id, r.n) for r in v] == [(7, 1001)]
    plan = contracts.pk_violations(hot)._jdf.queryExecution().sparkPlan().toString()
    assert "partial_count" in plan
