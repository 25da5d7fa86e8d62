"""Physical plan checks: the plans we want at scale."""

from tillroll.plans.registry import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _initial_plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_cube_has_no_window_and_no_python(spark, sf_small):
    for name in ("sales_cube", "cell_aggregate", "dashboard_all"):
        plan = _initial_plan(QUERIES[name](spark, sf_small))
        assert "Window" not in plan
        assert "Python" not in plan and "ArrowEval" not in plan
        assert "HashAggregate" in plan or name == "sales_cube"  # of which the cells are stored


def test_fact_joins_orders_by_shuffle(spark, sf_small):
    plan = _initial_plan(QUERIES["sales_fact"](spark, sf_small))
    assert "SortMergeJoin" in plan


def test_topk_is_take_ordered(spark, sf_small):
    df = QUERIES["top10_amount_cur"](spark, sf_small)
    assert "TakeOrderedAndProject" in _initial_plan(df)


def test_scan_prunes_columns(spark, sf_small):
    plan = _initial_plan(QUERIES["clip_quantity"](spark, sf_small))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_no_python_anywhere(spark, sf_small):
    for name, q in QUERIES.items():
        plan = _initial_plan(q(spark, sf_small))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


SF_LARGE = "/root/testdata/sf0.1"


def test_cells_are_not_dealt_by_a_dimension(spark):
    df = QUERIES["sales_cube_part_grain"](spark, SF_LARGE)
    df.write.format("noop").mode("overwrite").save()
    for plan in (_plan(df), _initial_plan(df)):
        # stored cells meet stored roll-ups whose bytes the planner knows before it runs
        assert "Exchange hashpartitioning" not in plan and "ShuffleExchange" not in plan
        assert plan.count("BroadcastHashJoin") >= 3 and "Window" not in plan


def test_large_product_rollup_keeps_small_ones_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["sales_cube_part_grain"](spark, "/root/testdata/sf0.01")
        plan = _initial_plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
    assert [x.count("product_id") > 0 for x in plan.splitlines() if "SortMergeJoin" in x] == [True]


def test_counts_come_from_footers(spark, sf_small):
    df = QUERIES["row_counts"](spark, sf_small)
    plan = _initial_plan(df)
    assert plan.count("PushedAggregation: [COUNT(*)]") + plan.count("BatchScan parquet") >= 14
    assert "FileScan" not in plan
    # a footer count of a table without the asked column, folders included
    from tillroll.operators.monitoring import parquet_row_counts
    counts = parquet_row_counts(spark, {"h": "/root/testdata/check_h/labels.parquet"}, "x").first()
    assert counts.row_count == spark.read.parquet("/root/testdata/check_h/labels.parquet").count()
